"""Fixture views over the given tables, most of them over ``events``.

The texts run unchanged in Spark SQL and in DuckDB, so queries and their
oracles start from the same rows. ``NEEDS`` names the views a view reads.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

SQL = {
    "fx_ports": """
SELECT * FROM (VALUES
 (0,'AMSTERDAM','NL',52.366667e0,4.9e0),(1,'LEITH','GB',55.983333e0,-3.183333e0),(2,'DUNDEE','GB',56.466667e0,-2.95e0),
 (3,'TILBURY','GB',51.466667e0,0.333333e0),(4,'ROTTERDAM','NL',51.9e0,4.483333e0),(5,'ANTWERPEN','BE',51.216667e0,4.4e0),
 (6,'ZEEBRUGGE','BE',51.333333e0,3.2e0),(7,'HAMBURG','DE',53.55e0,9.933333e0),(8,'BREMEN','DE',53.133333e0,8.766667e0),
 (9,'STAVANGER','NO',58.966667e0,5.75e0),
 (10,'CALAIS','FR',50.966667e0,1.85e0),(11,'SKAGEN HAVN','DK',57.716667e0,10.6e0),(12,'GOTEBORG','SE',57.7e0,11.966667e0)) AS p(port_id,port_name,country,latitude,longitude)
""",
    "fx_ships": """
SELECT DISTINCT 9000000 + user_id AS imo_number, 200000000 + user_id AS mmsi, concat('VESSEL ', CAST(user_id AS VARCHAR(10))) AS name,
 CASE user_id % 8 WHEN 0 THEN '70' WHEN 1 THEN '80.0' WHEN 2 THEN ' 52 ' WHEN 3 THEN '30' WHEN 4 THEN 'abc' WHEN 5 THEN '999' WHEN 6 THEN '  ' ELSE NULL END AS ship_type,
 CAST(50 + user_id % 300 AS INT) AS length, CAST(10 + user_id % 40 AS INT) AS width,
 CASE WHEN user_id % 11 = 0 THEN NULL ELSE 10e0 + user_id % 7 END AS emission_berth, CASE WHEN user_id % 11 = 0 THEN NULL ELSE 20e0 + user_id % 5 END AS emission_anchor,
 CASE WHEN user_id % 11 = 0 THEN NULL ELSE 30e0 + user_id % 3 END AS emission_maneuver, CASE WHEN user_id % 11 = 0 THEN NULL ELSE 90e0 + user_id % 13 END AS emission_cruise FROM events
""",
    "fx_scrubbers": """
SELECT DISTINCT CAST(9000000 + user_id AS VARCHAR(10)) AS imo_number, 'Fitted' AS sox_scrubber_status FROM events WHERE user_id % 3 = 0
""",
    "fx_positions": """
SELECT e.event_id AS id, 9000000 + e.user_id AS imo_number, 200000000 + e.user_id AS mmsi, e.ts AS timestamp_collected, e.ts AS timestamp_ais,
 CASE WHEN e.event_id % 101 = 0 THEN NULL ELSE p.latitude + CAST((e.event_id * 7919) % 601 - 300 AS DOUBLE) / 1000e0 END AS latitude,
 CASE WHEN e.event_id % 101 = 0 THEN NULL ELSE p.longitude + CAST((e.event_id * 104729) % 601 - 300 AS DOUBLE) / 1000e0 END AS longitude,
 CASE e.event_id % 14 WHEN 0 THEN 'NLRTM' WHEN 1 THEN ' rotterdam ' WHEN 2 THEN 'BE ANR' WHEN 3 THEN 'ROTTERDAM MAAS' WHEN 4 THEN 'NLRTM>GBHRW' WHEN 5 THEN 'HULL-ROTT' WHEN 6 THEN '0'
  WHEN 7 THEN 'AMSTERDM' WHEN 8 THEN '' WHEN 9 THEN NULL WHEN 10 THEN 'DE HAM' WHEN 11 THEN 'FISHING GROUNDS' WHEN 12 THEN 'ANT' ELSE 'OSLO' END AS destination,
 LEAST(e.value / 10e0, 30e0) AS sog, CAST((e.event_id * 37) % 360 AS DOUBLE) AS cog,
 CASE WHEN e.event_id % 97 = 0 THEN NULL ELSE CAST(e.event_id % 17 AS INT) END AS navigational_status_code,
 CAST((e.event_id * 53) % 360 AS INT) AS true_heading
 FROM events e JOIN fx_ports p ON p.port_id = e.user_id % 13
""",
    "fx_messages": """
SELECT event_id, concat('{"MessageType":"', CASE WHEN event_id % 4 = 0 THEN 'ShipStaticData' ELSE 'PositionReport' END,
 '","MetaData":{"MMSI":', CAST(200000000 + user_id AS VARCHAR(12)), ',"latitude":', CAST(50 + event_id % 12 AS VARCHAR(4)), '.25,"longitude":', CAST(event_id % 14 AS VARCHAR(4)),
 '.5,"time_utc":"', CASE WHEN event_id % 89 = 0 THEN 'bad' ELSE concat('2024-01-', lpad(CAST(1 + event_id % 28 AS VARCHAR(2)), 2, '0'), ' 10:00:00.', lpad(CAST(event_id % 1000000 AS VARCHAR(6)), 6, '0'), '789 +0000 UTC') END,
 '"},"Message":', CASE WHEN event_id % 4 = 0 THEN concat('{"ShipStaticData":{"ImoNumber":', CASE WHEN user_id % 10 = 9 THEN '0' WHEN user_id % 10 = 8 THEN 'null' ELSE CAST(9000000 + user_id AS VARCHAR(10)) END,
 ',"Name":"V', CAST(user_id AS VARCHAR(4)), '","Type":70,"Dimension":{"A":', CAST(event_id % 200 AS VARCHAR(4)), ',"B":20,"C":', CASE WHEN event_id % 12 = 0 THEN 'null' ELSE '9' END, ',"D":8},"MaximumStaticDraught":7.5,"Destination":"NLRTM"}}')
 ELSE concat('{"PositionReport":{"Sog":', CAST(event_id % 20 AS VARCHAR(3)), '.5,"Cog":120.5,"NavigationalStatus":', CAST(event_id % 16 AS VARCHAR(3)), ',"RateOfTurn":0,"TrueHeading":90}}') END,
 CASE WHEN event_id % 83 = 0 THEN '' ELSE '}' END) AS raw FROM events
""",
    "fx_nav_status": """
SELECT * FROM (VALUES (0,'Underway using engine'),(1,'At anchor'),(2,'Not under command'),(3,'Restricted maneuverability'),(5,'Moored'),(15,'Undefined')) AS t(navigational_status_code,navigational_status)
""",
    "fx_ship_type_codes": """
SELECT * FROM (VALUES (30,'Fishing',NULL),(52,'Tug',NULL),(70,'Cargo','All ships of this type'),(80,'Tanker','All ships of this type')) AS t(type_code,type,remark)
""",
    "fx_port_bans": """
SELECT * FROM (VALUES ('AMSTERDAM',1),('LEITH',1),('DUNDEE',1),('HAMBURG',1),('SKAGEN HAVN',2),('GOTEBORG',2),('ROTTERDAM',0)) AS t(port_name,scrubber_status)
""",
    "fx_region": """
SELECT * FROM (VALUES (0,0,0e0,51e0),(0,1,6e0,51e0),(0,2,6e0,54e0),(0,3,0e0,54e0),(1,0,4e0,57e0),(1,1,12e0,57e0),(1,2,8e0,60e0)) AS t(region_id,seq,lon,lat)
""",
    "fx_daily": """
SELECT CAST(ts AS DATE) AS date, event_type AS country, round(sum(value), 4) AS pollution FROM events GROUP BY CAST(ts AS DATE), event_type
""",
    # Land around Hamburg and Bremen: two rectangles.
    "fx_land": """
SELECT * FROM (VALUES (0,0,9.7e0,53.4e0),(0,1,10.1e0,53.4e0),(0,2,10.1e0,53.65e0),(0,3,9.7e0,53.65e0),
 (1,0,8.5e0,53.0e0),(1,1,8.9e0,53.0e0),(1,2,8.9e0,53.25e0),(1,3,8.5e0,53.25e0)) AS t(region_id,seq,lon,lat)
""",
    # Reference tables of the size of the given ones.
    "fx_harbours": """
SELECT CAST(s_suppkey AS INT) AS port_id, s_name AS port_name, n_name AS country, round(50 + (s_suppkey % 997) / 100e0, 2) AS latitude,
 round((s_suppkey * 7 % 1500) / 100e0, 2) AS longitude FROM supplier JOIN nation ON n_nationkey = s_nationkey
""",
    "fx_harbour_bans": """
SELECT s_name AS port_name, CAST(s_suppkey % 3 AS INT) AS scrubber_status FROM supplier WHERE s_suppkey % 4 < 2
""",
    "fx_part_codes": """
SELECT CAST(p_partkey % 97 AS INT) AS type_code, p_type AS type, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_brand END AS remark FROM part
""",
    # Reports with a tenth of them stored twice.
    "fx_duplicated": """
SELECT * FROM fx_positions UNION ALL
SELECT id + 1000000000 AS id, imo_number, mmsi, timestamp_collected + INTERVAL '1' HOUR AS timestamp_collected, timestamp_ais,
 latitude, longitude, destination, sog, cog, navigational_status_code, true_heading FROM fx_positions WHERE id % 10 = 0
""",
}

NEEDS = {"fx_positions": ["fx_ports"], "fx_duplicated": ["fx_positions"]}


def with_views(*names: str, extra: dict[str, tuple[list[str], str]] | None = None) -> str:
    """``WITH`` clause that defines the views and everything they read, for the oracles."""
    derived, ordered = extra or {}, {}

    def add(name: str) -> None:
        if name in ordered:
            return
        needs, text = derived[name] if name in derived else (NEEDS.get(name, []), SQL[name])
        for each in needs:
            add(each)
        ordered[name] = f"{name} AS MATERIALIZED ({text.strip()})"

    for name in names:
        add(name)
    return "WITH " + ",\n".join(ordered.values())


# Given tables that views read beside ``events``.
GIVEN = ("supplier", "nation", "part")


class Fixtures:
    """Fixture views as DataFrames: ``Fixtures(spark, sf_dir).positions`` is ``fx_positions``."""

    def __init__(self, spark: SparkSession, sf_dir: str, events: DataFrame | None = None):
        self.spark, self.sf_dir = spark, sf_dir
        self.events = events if events is not None else spark.read.parquet(f"{sf_dir}/events.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        view = f"fx_{name}"
        if view not in SQL:
            raise AttributeError(name)
        needed = {v: getattr(self, v.removeprefix("fx_")) for v in NEEDS.get(view, [])}
        text = SQL[view].replace("{", "{{").replace("}", "}}").replace("FROM events", "FROM {events}")
        for v in needed:
            for word in ("FROM", "JOIN"):
                text = text.replace(f"{word} {v} ", f"{word} {{{v}}} ")
        used = {"events": self.events} if "{events}" in text else {}
        for name in GIVEN:
            text, found = re.subn(rf"\b(FROM|JOIN) {name}\b", rf"\1 {{{name}}}", text)
            if found:
                used[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self.spark.sql(text, **used, **needed)
