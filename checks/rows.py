"""Row-level operators: coordinates, times, codes, texts, messages."""

from pyspark.sql import functions as F

from checks import expected
from checks.fixtures import Fixtures, with_views
from checks.registry import query, rounded
from checks.views import cleaned, corrected, given, haversine, in_region, inland, mapped, mode, ts
from tidewake.functions import ais, geo
from tidewake.functions import destinations as dest
from tidewake.operators.lookups import category_of_type, enrich_positions, enrich_ships, exclude_rows
from tidewake.operators.regions import is_inland, within_region
from tidewake.operators.spatial import any_site_within, density_grid, heat_points, marker_points, nearest_site
from tidewake.operators.temporal import latest_state, recent
from tidewake.plans.destinations import normalize_destinations, profile_destinations
from tidewake.plans.extract import movement_extract
from tidewake.plans.profile import fill_defaults
from tidewake.session import materialize
from tidewake.sources.messages import ingest, parse_messages
from tidewake.sources.regions import rings_from_vertices

def lat():
    return F.col("latitude")


def lon():
    return F.col("longitude")


def region(fx: Fixtures):
    return rings_from_vertices(fx.region)


def land(fx: Fixtures):
    return rings_from_vertices(fx.land)


def messages(fx: Fixtures):
    return ingest(fx.messages.withColumnRenamed("event_id", "seq"), region(fx))


def stored_messages(fx: Fixtures):
    """Routed messages as a table, as the collector leaves them."""
    return materialize(messages(fx).drop("raw"), "messages")


def extract(fx: Fixtures):
    return movement_extract(fx.ships, fx.positions, fx.scrubbers)


def stored_extract(fx: Fixtures):
    """The extract as a table, as reports read it."""
    return materialize(extract(fx), "extract")


@query("bbox_filter", given("fx_positions") + """
SELECT id, latitude, longitude FROM fx_positions
WHERE latitude BETWEEN 50 AND 61.5 AND longitude BETWEEN -5 AND 13""")
def _(fx):
    return fx.positions.where(geo.within_bbox(lat(), lon(), geo.SUBSCRIPTION_BOX)).select("id", "latitude", "longitude")


@query("region_filter", given("fx_positions") + f"""
SELECT id, {in_region('latitude', 'longitude')} AS in_region FROM fx_positions""")
def _(fx):
    return within_region(fx.positions, region(fx)).select("id", "in_region")


@query("inland_flag", given("fx_positions") + f"""
SELECT id, {inland('latitude', 'longitude')} AS inland FROM fx_positions""")
def _(fx):
    return is_inland(fx.positions, land(fx)).select("id", "inland")


@query("haversine_pairs", given("fx_positions") + f"""
SELECT id, round({haversine('latitude', 'longitude', '51.9e0', '4.483333e0')}, 4) AS to_rotterdam,
 round({haversine('latitude', 'longitude', '53.55e0', '9.933333e0')}, 4) AS to_hamburg FROM fx_positions""")
def _(fx):
    def to(north, east):
        return F.round(geo.haversine_nm(lat(), lon(), F.lit(north), F.lit(east)), 4)
    return fx.positions.select("id", to(51.9, 4.483333).alias("to_rotterdam"), to(53.55, 9.933333).alias("to_hamburg"))


NEAREST = f"""
SELECT x.id, n.port_id AS nearest_port_id, n.country AS nearest_country, round(n.nm, 4) AS nearest_nm FROM fx_positions x
LEFT JOIN (SELECT * FROM (SELECT y.id, p.port_id, p.country, {haversine('y.latitude', 'y.longitude', 'p.latitude', 'p.longitude')} AS nm,
 row_number() OVER (PARTITION BY y.id ORDER BY {haversine('y.latitude', 'y.longitude', 'p.latitude', 'p.longitude')}, p.port_id) AS rn
 FROM fx_positions y, fx_ports p WHERE y.latitude IS NOT NULL) WHERE rn = 1) n ON n.id = x.id"""


@query("nearest_port", given("fx_positions") + NEAREST)
def _(fx):
    near = nearest_site(fx.positions, fx.ports).select("id", "nearest_port_id", "nearest_country", "nearest_nm")
    return rounded(near, nearest_nm=4)


@query("nearest_port_by_cell", given("fx_positions") + NEAREST)
def _(fx):
    near = nearest_site(fx.positions, fx.ports, max_unrolled=0)
    return rounded(near.select("id", "nearest_port_id", "nearest_country", "nearest_nm"), nearest_nm=4)


@query("ports_within_3nm", given("fx_positions") + f"""
SELECT x.id, EXISTS (SELECT 1 FROM fx_ports p WHERE {haversine('x.latitude', 'x.longitude', 'p.latitude', 'p.longitude')} <= 3) AS near_port
FROM fx_positions x""")
def _(fx):
    return any_site_within(fx.positions, fx.ports, 3, "near_port").select("id", "near_port")


@query("density_grid", given("fx_positions") + """
SELECT CAST(floor(latitude / 0.25e0) AS BIGINT) AS lat_cell, CAST(floor(longitude / 0.25e0) AS BIGINT) AS lon_cell, count(*) AS weight
FROM fx_positions WHERE latitude IS NOT NULL GROUP BY 1, 2""")
def _(fx):
    return density_grid(fx.positions)


@query("heat_points", given("fx_positions") + """
SELECT latitude, longitude, 1 AS weight FROM fx_positions
WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180""")
def _(fx):
    return heat_points(fx.positions)


@query("marker_points", given("ext") + """
SELECT imo_number, arg_max(latitude, (timestamp_collected, id)) FILTER (WHERE latitude IS NOT NULL) AS latitude,
 arg_max(longitude, (timestamp_collected, id)) FILTER (WHERE longitude IS NOT NULL) AS longitude, max(name) AS name, max(ship_type) AS ship_type,
 arg_max(destination, (timestamp_collected, id)) FILTER (WHERE destination IS NOT NULL) AS destination
FROM ext WHERE has_scrubber GROUP BY imo_number""")
def _(fx):
    return marker_points(latest_state(extract(fx), "imo_number", ["timestamp_collected", "id"]))


@query("valid_coordinates", given("fx_positions") + """
SELECT id, coalesce(latitude * 2 BETWEEN -90 AND 90 AND longitude * 20 BETWEEN -180 AND 180, FALSE) AS valid,
 CASE WHEN id % 3 = 0 THEN NULL ELSE sog END AS speed
FROM fx_positions""")
def _(fx):
    text = F.when(F.col("id") % 3 == 0, "n/a").otherwise(F.col("sog").cast("string"))
    return fx.positions.select(
        "id", geo.valid_coordinates(lat() * 2, lon() * 20).alias("valid"), geo.as_number(text).alias("speed")
    )


@query("parse_ais_timestamp", given("prs") + f"SELECT seq, {ts('timestamp_ais')} AS timestamp_ais FROM prs")
def _(fx):
    parsed = parse_messages(fx.messages)
    return parsed.select(F.col("event_id").alias("seq"), "timestamp_ais")


@query("parse_messages_static", given("prs") + f"""
SELECT seq, mmsi, latitude, longitude, {ts('timestamp_ais')} AS timestamp_ais, raw_imo, coalesce(name, 'Unknown') AS name, ship_type,
 length, width, max_draught, coalesce(destination, 'Unknown') AS destination
FROM prs WHERE message_type = 'ShipStaticData'""")
def _(fx):
    parsed = parse_messages(fx.messages).where((F.col("message_type") == "ShipStaticData") & ~F.col("reject").eqNullSafe("malformed"))
    return parsed.select(
        F.col("event_id").alias("seq"), "mmsi", "latitude", "longitude", "timestamp_ais", "raw_imo", "name", "ship_type",
        "length", "width", "max_draught", "destination",
    )


@query("parse_messages_position", given("prs") + f"""
SELECT seq, mmsi, latitude, longitude, {ts('timestamp_ais')} AS timestamp_ais, sog, cog, navigational_status_code, rate_of_turn, true_heading
FROM prs WHERE message_type = 'PositionReport'""")
def _(fx):
    parsed = parse_messages(fx.messages).where((F.col("message_type") == "PositionReport") & ~F.col("reject").eqNullSafe("malformed"))
    return parsed.select(
        F.col("event_id").alias("seq"), "mmsi", "latitude", "longitude", "timestamp_ais", "sog", "cog",
        "navigational_status_code", "rate_of_turn", "true_heading",
    )


@query("message_routing", given("routed") + """
SELECT seq, route, CASE WHEN message_type <> 'ShipStaticData' OR message_type IS NULL THEN NULL
 WHEN raw_imo IS NULL THEN -1 ELSE raw_imo END AS imo_number FROM routed""")
def _(fx):
    return messages(fx).select("seq", "route", "imo_number")


@query("message_routing_keep_unknown", given("routed") + """
SELECT CASE route WHEN 'no_imo' THEN 'unknown' ELSE route END AS route, count(*) AS n FROM routed GROUP BY 1""")
def _(fx):
    kept = ingest(fx.messages.withColumnRenamed("event_id", "seq"), region(fx), keep_unknown=True)
    return kept.groupBy("route").agg(F.count(F.lit(1)).alias("n"))


@query("bad_messages", given("routed") + "SELECT seq, raw, reject FROM routed WHERE route = 'quarantine'")
def _(fx):
    return messages(fx).where(F.col("route") == "quarantine").select("seq", "raw", "reject")


@query("operation_mode", given("fx_positions") + f"SELECT id, {mode('navigational_status_code')} AS operation_mode FROM fx_positions")
def _(fx):
    return fx.positions.select("id", ais.operation_mode(F.col("navigational_status_code")).alias("operation_mode"))


@query("nav_status_text", given("fx_positions", "fx_nav_status") + """
SELECT p.id, coalesce(s.navigational_status, 'Unknown') AS navigational_status FROM fx_positions p
LEFT JOIN fx_nav_status s ON s.navigational_status_code = p.navigational_status_code""")
def _(fx):
    return enrich_positions(fx.positions, fx.nav_status).select("id", "navigational_status")


@query("nav_status_from_text", given("fx_positions", "fx_nav_status") + """
SELECT p.id, coalesce(s.navigational_status, 'Unknown') AS navigational_status FROM fx_positions p
LEFT JOIN fx_nav_status s ON s.navigational_status_code = p.navigational_status_code AND p.id % 5 <> 0""")
def _(fx):
    code = F.col("navigational_status_code")
    text = F.when(F.col("id") % 5 == 0, "x").otherwise(F.concat(F.lit(" "), code.cast("string"), F.lit(".0 ")))
    return enrich_positions(fx.positions.withColumn("navigational_status_code", text), fx.nav_status).select(
        "id", "navigational_status"
    )


@query("ship_type_label", given("fx_ships", "fx_ship_type_codes") + """
, parsed AS (SELECT *, CAST(trunc(TRY_CAST(trim(ship_type) AS DOUBLE)) AS INTEGER) AS code FROM fx_ships)
SELECT p.imo_number, coalesce(CAST(p.code AS VARCHAR), p.ship_type) AS ship_type,
 CASE WHEN t.type_code IS NOT NULL THEN t.type ELSE 'Unknown' END AS type_name,
 CASE WHEN p.ship_type IS NULL OR trim(p.ship_type) = '' THEN 'No ship type provided' WHEN p.code IS NULL THEN 'Invalid ship type'
  WHEN t.type_code IS NOT NULL THEN t.remark ELSE 'Unknown' END AS type_remark
FROM parsed p LEFT JOIN fx_ship_type_codes t ON t.type_code = p.code""")
def _(fx):
    return enrich_ships(fx.ships, fx.ship_type_codes).select("imo_number", "ship_type", "type_name", "type_remark")


@query("ship_type_category", given("fx_ships", "fx_ship_type_codes") + """
SELECT s.imo_number, t.type AS ship_type FROM fx_ships s LEFT JOIN fx_ship_type_codes t ON s.ship_type = CAST(t.type_code AS VARCHAR)""")
def _(fx):
    return category_of_type(fx.ships, fx.ship_type_codes).select("imo_number", "ship_type")


@query("clean_destination", given("fx_positions") + f"SELECT id, {cleaned('destination')} AS destination FROM fx_positions")
def _(fx):
    return fx.positions.select("id", dest.clean_destination(F.col("destination")).alias("destination"))


@query("map_destination_codes", given("fx_positions") + f"""
SELECT id, {mapped(cleaned('destination'), expected.PORT_CODES)} AS destination FROM fx_positions""")
def _(fx):
    return fx.positions.select("id", dest.map_codes(dest.clean_destination(F.col("destination"))).alias("destination"))


@query("destination_rules", given("fx_positions") + f"""
SELECT id, {corrected(cleaned('destination'), expected.CORRECTIONS)} AS destination FROM fx_positions""")
def _(fx):
    return fx.positions.select("id", dest.apply_rules(dest.clean_destination(F.col("destination"))).alias("destination"))


@query("split_destination", given("split", "fixed") + """
SELECT f.id, s.primary_port, s.secondary_port FROM fixed f LEFT JOIN split s ON s.d = f.d""")
def _(fx):
    fixed = dest.apply_rules(dest.map_codes(dest.clean_destination(F.col("destination"))))
    ports = fx.positions.select("id", dest.split_destination(fixed).alias("p"))
    return ports.select("id", F.col("p.primary").alias("primary_port"), F.col("p.secondary").alias("secondary_port"))


@query("normalize_destinations", given("norm") + "SELECT id, destination, secondary_destination FROM norm")
def _(fx):
    return normalize_destinations(fx.positions).select("id", "destination", "secondary_destination")


@query("normalize_destinations_by_row", given("norm") + "SELECT id, destination, secondary_destination FROM norm")
def _(fx):
    return normalize_destinations(fx.positions, lookup=False).select("id", "destination", "secondary_destination")


@query("profile_destinations", given("profiled") + "SELECT id, destination FROM profiled")
def _(fx):
    return profile_destinations(fx.positions).select("id", "destination")


@query("fill_defaults", given("fx_positions") + """
SELECT id, coalesce(destination, 'Unknown') AS destination, coalesce(sog, 0) AS sog, coalesce(cog, 0) AS cog, latitude FROM fx_positions""")
def _(fx):
    return fill_defaults(fx.positions.select("id", "destination", "sog", "cog", "latitude"))


@query("date_parts", given("fx_positions") + """
SELECT id, CAST(CAST(timestamp_collected AS DATE) AS VARCHAR) AS date, CAST(hour(timestamp_collected) AS INTEGER) AS hour,
 CAST(isodow(timestamp_collected) - 1 AS INTEGER) AS day_of_week, CAST(month(timestamp_collected) AS INTEGER) AS month,
 CAST(day(timestamp_collected) AS INTEGER) AS day FROM fx_positions""")
def _(fx):
    parts = ais.date_parts(F.col("timestamp_collected"))
    return fx.positions.select("id", *[c.alias(n) for n, c in parts.items()])


@query("time_range", given("fx_positions") + f"""
SELECT id, {ts('timestamp_collected')} AS timestamp_collected FROM fx_positions
WHERE timestamp_collected >= TIMESTAMP '2024-01-08' AND timestamp_collected < TIMESTAMP '2024-01-15'""")
def _(fx):
    wanted = ais.in_range(F.col("timestamp_collected"), "2024-01-08", "2024-01-15")
    return fx.positions.where(wanted).select("id", "timestamp_collected")


@query("last_seven_days", given("fx_positions") + """
SELECT id FROM fx_positions WHERE timestamp_collected >= TIMESTAMP '2024-01-22 12:00:00'::DATE - INTERVAL 7 DAY""")
def _(fx):
    return recent(fx.positions, "timestamp_collected", "2024-01-22 12:00:00", 7).select("id")


@query("exclude_rows", given("profiled", "fx_positions") + """
SELECT p.id, d.destination FROM fx_positions p JOIN profiled d ON d.id = p.id
WHERE d.destination IS DISTINCT FROM 'FISHING' AND p.navigational_status_code IS DISTINCT FROM 5""")
def _(fx):
    cleaned_rows = profile_destinations(fx.positions)
    return exclude_rows(cleaned_rows, {"destination": "FISHING", "navigational_status_code": 5}).select("id", "destination")


@query("vessel_dimensions", with_views("fx_messages") + """
SELECT event_id AS seq, CASE WHEN event_id % 83 <> 0 THEN CAST(event_id % 200 + 20 AS INTEGER) END AS length,
 CASE WHEN event_id % 12 <> 0 AND event_id % 83 <> 0 THEN 17 END AS width FROM fx_messages WHERE event_id % 4 = 0 AND event_id % 83 <> 0""")
def _(fx):
    parsed = parse_messages(fx.messages).where((F.col("message_type") == "ShipStaticData") & ~F.col("reject").eqNullSafe("malformed"))
    return parsed.select(F.col("event_id").alias("seq"), "length", "width")
