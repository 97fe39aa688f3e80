"""SQL building blocks of the oracles."""

from __future__ import annotations

from checks.expected import CORRECTIONS, NAV_STATUSES, PORT_CODES, PROFILE_CODES, PROFILE_CORRECTIONS
from checks.fixtures import with_views


def ts(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"


def haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"2 * 3440.065e0 * asin(sqrt(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + cos(radians({lat1})) * "
        f"cos(radians({lat2})) * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2)))"
    )


def in_rectangle(lat: str, lon: str, west: float, east: float, south: float, north: float) -> str:
    return f"({lon} > {west} AND {lon} < {east} AND {lat} > {south} AND {lat} < {north})"


def in_region(lat: str, lon: str) -> str:
    """Closed form of fx_region: rectangle and triangle, strictly inside."""
    triangle = f"({lat} > 57 AND {lat} < 57 + ({lon} - 4) * 0.75e0 AND {lat} < 57 + (12 - {lon}) * 0.75e0)"
    return f"coalesce({in_rectangle(lat, lon, 0, 6, 51, 54)} OR {triangle}, FALSE)"


def on_land(lat: str, lon: str) -> str:
    return f"({in_rectangle(lat, lon, 9.7, 10.1, 53.4, 53.65)} OR {in_rectangle(lat, lon, 8.5, 8.9, 53.0, 53.25)})"


def inland(lat: str, lon: str) -> str:
    return f"coalesce({on_land(lat, f'({lon} - 0.01e0)')} AND {on_land(lat, f'({lon} + 0.01e0)')}, FALSE)"


def mode(code: str) -> str:
    return (
        f"CASE WHEN {code} IN (0,7,8,9,10,11,12,13,14,15) THEN 'Cruise' WHEN {code} IN (1,2) THEN 'Anchor' "
        f"WHEN {code} IN (3,4) THEN 'Maneuver' WHEN {code} IN (5,6) THEN 'Berth' END"
    )


def cleaned(column: str) -> str:
    return f"regexp_replace(upper(trim({column})), '[^A-Z0-9]', '', 'g')"


def mapped(text: str, codes: dict[str, str]) -> str:
    cases = " ".join(f"WHEN '{c}' THEN '{n}'" for c, n in codes.items())
    return f"CASE {text} {cases} ELSE {text} END"


def corrected(text: str, rules) -> str:
    for pattern, replacement in rules:
        text = f"regexp_replace({text}, '{pattern}', '{replacement}', 'g')"
    return text


STATUS_ROWS = ", ".join(f"({i}, '{text}')" for i, text in enumerate(NAV_STATUSES))
CODE_ROWS = ", ".join(f"({i}, '{c}', '{n}')" for i, (c, n) in enumerate(PORT_CODES.items()))

SPLIT = f"""
 SELECT v.d,
  CASE WHEN length(v.d) <= 5 THEN v.d WHEN contains(v.d, 'ROTT') AND contains(v.d, 'HULL') THEN 'ROTTERDAM'
   ELSE coalesce(s.name, v.d) END AS primary_port,
  CASE WHEN length(v.d) <= 5 THEN NULL WHEN contains(v.d, 'ROTT') AND contains(v.d, 'HULL') THEN 'HULL' ELSE x.sec END AS secondary_port
 FROM fixed_values v
 LEFT JOIN (SELECT d, arg_min(name, k) AS name, min(k) AS k FROM hits WHERE name <> d GROUP BY d) s ON s.d = v.d
 LEFT JOIN (SELECT h.d, arg_max(h.sec, h.k) AS sec FROM hits h
            LEFT JOIN (SELECT d, min(k) AS k FROM hits WHERE name <> d GROUP BY d) f ON f.d = h.d
            WHERE h.sec IS NOT NULL AND h.k <= coalesce(f.k, 99) GROUP BY h.d) x ON x.d = v.d"""

DERIVED: dict[str, tuple[list[str], str]] = {
    "stats": (["fx_positions", "fx_ships", "fx_scrubbers"], """
 SELECT s.imo_number, s.name, s.ship_type, c.imo_number IS NOT NULL AS has_scrubber, count(*) AS position_count,
  avg(p.sog) AS avg_speed, min(p.timestamp_collected) AS first_seen, max(p.timestamp_collected) AS last_seen,
  count(DISTINCT p.destination) AS unique_destinations
 FROM fx_ships s LEFT JOIN fx_scrubbers c ON CAST(s.imo_number AS VARCHAR) = c.imo_number
 JOIN fx_positions p ON p.imo_number = s.imo_number
 GROUP BY s.imo_number, s.name, s.ship_type, c.imo_number"""),
    "ext": (["stats"], """
 SELECT p.id, s.*, p.latitude, p.longitude, p.sog, p.cog, p.navigational_status_code, p.timestamp_collected, p.destination
 FROM stats s JOIN fx_positions p ON p.imo_number = s.imo_number"""),
    "aug": (["ext"], f"""
 SELECT e.*, {mode('e.navigational_status_code')} AS operation_mode, f.emission_berth, f.emission_anchor,
  f.emission_maneuver, f.emission_cruise
 FROM ext e LEFT JOIN fx_ships f ON f.imo_number = e.imo_number AND e.has_scrubber"""),
    "dist": (["aug", "fx_ports"], f"""
 SELECT x.id, p.port_id, p.port_name, p.country, {haversine('x.latitude', 'x.longitude', 'p.latitude', 'p.longitude')} AS nm
 FROM aug x, fx_ports p WHERE x.latitude IS NOT NULL AND x.longitude IS NOT NULL"""),
    "near": (["dist"], """
 SELECT id, port_id, country, nm FROM
  (SELECT *, row_number() OVER (PARTITION BY id ORDER BY nm, port_id) AS rn FROM dist) WHERE rn = 1"""),
    "gaps": (["aug"], """
 SELECT id, date_diff('microsecond', lag(timestamp_collected) OVER (PARTITION BY imo_number ORDER BY timestamp_collected, id),
  timestamp_collected) / 3600e6 AS time_diff FROM aug"""),
    "port_block": (["dist", "aug"], """
 SELECT d.id, bool_or(d.nm <= 3 AND ((d.port_name IN ('TILBURY', 'AMSTERDAM') AND a.operation_mode = 'Berth')
  OR (d.port_name IN ('LEITH', 'DUNDEE') AND a.operation_mode IN ('Berth', 'Anchor')))) AS blocked
 FROM dist d JOIN aug a ON a.id = d.id GROUP BY d.id"""),
    "values_14": ([], f"SELECT * FROM (VALUES {CODE_ROWS}) AS c(k, code, name)"),
    "fixed": (["fx_positions"], f"""
 SELECT id, {corrected(mapped(cleaned('destination'), PORT_CODES), CORRECTIONS)} AS d FROM fx_positions"""),
    "fixed_values": (["fixed"], "SELECT DISTINCT d FROM fixed"),
    "hits": (["fixed_values", "values_14"], """
 SELECT v.d, c.k, c.name,
  (SELECT arg_min(o.name, o.k) FROM values_14 o WHERE contains(replace(v.d, c.code, ''), o.code)) AS sec
 FROM fixed_values v JOIN values_14 c ON contains(v.d, c.code)"""),
    "split": (["hits"], SPLIT),
    "norm": (["split", "fixed"], """
 SELECT f.id, nullif(s.primary_port, '') AS destination, s.secondary_port AS secondary_destination
 FROM fixed f LEFT JOIN split s ON s.d = f.d"""),
    "next": (["ext", "norm"], """
 SELECT e.* EXCLUDE (destination), n.destination, n.secondary_destination FROM ext e JOIN norm n ON n.id = e.id"""),
    "profiled": (["fx_positions"], f"""
 SELECT id, nullif({corrected(mapped(cleaned('destination'), PROFILE_CODES), PROFILE_CORRECTIONS)}, '') AS destination
 FROM fx_positions"""),
    "msg": (["fx_messages"], "SELECT event_id, raw, CASE WHEN json_valid(raw) THEN raw END AS j FROM fx_messages"),
    "prs": (["msg"], """
 SELECT event_id AS seq, raw, j, json_extract_string(j, '$.MessageType') AS message_type,
  CAST(json_extract_string(j, '$.MetaData.MMSI') AS BIGINT) AS mmsi,
  CAST(json_extract_string(j, '$.MetaData.latitude') AS DOUBLE) AS latitude,
  CAST(json_extract_string(j, '$.MetaData.longitude') AS DOUBLE) AS longitude,
  TRY_CAST(regexp_extract(replace(json_extract_string(j, '$.MetaData.time_utc'), ' UTC', ''),
   '^(\\d{4}-\\d{2}-\\d{2} \\d{2}:\\d{2}:\\d{2}\\.\\d{1,6})\\d* \\+\\d{4}$', 1) AS TIMESTAMP) AS timestamp_ais,
  CAST(json_extract_string(j, '$.Message.ShipStaticData.ImoNumber') AS BIGINT) AS raw_imo,
  json_extract_string(j, '$.Message.ShipStaticData.Name') AS name,
  json_extract_string(j, '$.Message.ShipStaticData.Type') AS ship_type,
  CAST(json_extract_string(j, '$.Message.ShipStaticData.Dimension.A') AS INTEGER) + CAST(json_extract_string(j, '$.Message.ShipStaticData.Dimension.B') AS INTEGER) AS length,
  CAST(json_extract_string(j, '$.Message.ShipStaticData.Dimension.C') AS INTEGER) + CAST(json_extract_string(j, '$.Message.ShipStaticData.Dimension.D') AS INTEGER) AS width,
  CAST(json_extract_string(j, '$.Message.ShipStaticData.MaximumStaticDraught') AS DOUBLE) AS max_draught,
  json_extract_string(j, '$.Message.ShipStaticData.Destination') AS destination,
  CAST(json_extract_string(j, '$.Message.PositionReport.Sog') AS DOUBLE) AS sog,
  CAST(json_extract_string(j, '$.Message.PositionReport.Cog') AS DOUBLE) AS cog,
  CAST(json_extract_string(j, '$.Message.PositionReport.NavigationalStatus') AS INTEGER) AS navigational_status_code,
  CAST(json_extract_string(j, '$.Message.PositionReport.RateOfTurn') AS DOUBLE) AS rate_of_turn,
  CAST(json_extract_string(j, '$.Message.PositionReport.TrueHeading') AS INTEGER) AS true_heading
 FROM msg"""),
    "routed": (["prs"], f"""
 SELECT *, CASE WHEN j IS NULL THEN 'malformed' WHEN timestamp_ais IS NULL THEN 'bad_time' END AS reject,
  CASE WHEN j IS NULL THEN 'quarantine' WHEN NOT {in_region('latitude', 'longitude')} THEN 'outside'
   WHEN timestamp_ais IS NULL THEN 'quarantine' WHEN message_type = 'PositionReport' THEN 'position'
   WHEN raw_imo IS NULL OR raw_imo = 0 THEN 'no_imo' ELSE 'static' END AS route
 FROM prs"""),
    "statics": (["routed"], "SELECT *, raw_imo AS imo_number FROM routed WHERE route = 'static'"),
    "named": (["routed", "statics", "fx_ships"], """
 SELECT p.seq, p.mmsi, p.timestamp_ais, coalesce(
  (SELECT arg_max(s.imo_number, s.seq) FROM statics s WHERE s.mmsi = p.mmsi AND s.seq < p.seq),
  (SELECT min(f.imo_number) FROM fx_ships f WHERE f.mmsi = p.mmsi AND f.mmsi % 2 = 0)) AS imo_number
 FROM routed p WHERE p.route = 'position'"""),
    "unstored": (["routed", "statics"], """
 SELECT p.seq, p.mmsi, p.timestamp_ais,
  (SELECT arg_max(s.imo_number, s.seq) FROM statics s WHERE s.mmsi = p.mmsi AND s.seq < p.seq) AS imo_number
 FROM routed p WHERE p.route = 'position'"""),
    "master": (["statics"], """
 SELECT imo_number, arg_min(mmsi, seq) AS mmsi, arg_max(name, seq) AS name, arg_max(ship_type, seq) AS ship_type,
  max(CASE WHEN rn = 1 THEN length END) AS length, max(CASE WHEN rn = 1 THEN width END) AS width,
  arg_max(max_draught, seq) AS max_draught
 FROM (SELECT *, row_number() OVER (PARTITION BY imo_number ORDER BY seq DESC) AS rn FROM statics) GROUP BY imo_number"""),
    "corrections": (["prs"], f"""
 SELECT *, raw_imo AS imo_number FROM prs WHERE j IS NOT NULL AND {in_region('latitude', 'longitude')}
  AND message_type = 'ShipStaticData' AND raw_imo <> 0"""),
    "fixes": (["corrections"], """
 SELECT imo_number, length, width, timestamp_ais, seq FROM
  (SELECT *, row_number() OVER (PARTITION BY imo_number ORDER BY seq) AS rn FROM corrections WHERE length IS NOT NULL OR width IS NOT NULL)
 WHERE rn = 1"""),
}


def given(*names: str) -> str:
    """``WITH`` clause of fixture views and derived views."""
    return with_views(*names, extra=DERIVED) + "\n"


ALLOWED = """coalesce(NOT b.blocked, TRUE)"""
ISO_ALLOWED = f"""coalesce(NOT b.blocked, TRUE) AND NOT coalesce(n.country IN ('FR', 'BE') AND n.nm <= 3, FALSE)
 AND NOT coalesce(n.country = 'DE' AND {inland('a.latitude', 'a.longitude')}, FALSE)"""


def polluted(allowed: str = ALLOWED) -> str:
    """WITH clause that ends in ``poll``: one row per report."""
    text = f"""
 SELECT a.id, a.imo_number, CAST(a.timestamp_collected AS DATE) AS date, g.time_diff, a.operation_mode,
  {allowed} AS discharge_allowed,
  CASE WHEN n.nm <= 12 THEN n.country ELSE 'INTERNATIONAL' END AS country,
  CASE WHEN {allowed} THEN CASE a.operation_mode WHEN 'Berth' THEN a.emission_berth * g.time_diff
   WHEN 'Anchor' THEN a.emission_anchor * g.time_diff WHEN 'Maneuver' THEN a.emission_maneuver * g.time_diff
   WHEN 'Cruise' THEN a.emission_cruise * g.time_diff ELSE 0e0 END ELSE 0e0 END AS pollution
 FROM aug a JOIN gaps g ON g.id = a.id LEFT JOIN near n ON n.id = a.id LEFT JOIN port_block b ON b.id = a.id"""
    return with_views("poll", extra={**DERIVED, "poll": (["aug", "gaps", "near", "port_block"], text)}) + "\n"
