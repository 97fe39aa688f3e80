"""Joins, windows, aggregates, maintenance and reference tables."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.registry import query, rounded
from checks.rows import extract, land, messages, region, stored_extract, stored_messages
from checks.views import ALLOWED, ISO_ALLOWED, STATUS_ROWS, given, in_region, polluted, ts
from tidewake import schemas
from tidewake.operators import aggregate, lookups, maintain, temporal
from tidewake.operators.regions import keep_region, within_region
from tidewake.plans import extract as extract_plan
from tidewake.plans import pollution as pollution_plan
from tidewake.plans import profile
from tidewake.plans.destinations import normalize_destinations
from tidewake.plans.report import destination_report, latest_positions, movement_report
from tidewake.session import shared_dir
from tidewake.sources import files, tables, writeback
from tidewake.sources.messages import identified_statics
from tidewake.sources.regions import read_rings

ISO = pollution_plan.ISO_COUNTRY_RULES


def augmented(fx):
    return extract_plan.augmented_extract(extract(fx), fx.ships)


def polluted_rows(fx):
    return pollution_plan.pollution(augmented(fx), fx.ports)


def statics(fx, routed=None):
    return (messages(fx) if routed is None else routed).where(F.col("route") == "static")


def uncorrected_ships(fx):
    """Ship master in which every fifth ship was corrected before."""
    done = (F.col("imo_number") % 5 == 0)
    return fx.ships.where("imo_number % 7 <> 0").select(
        "imo_number", "mmsi", "length", "width", done.alias("lw_correction"),
        F.lit(None).cast("timestamp_ntz").alias("lw_correction_timestamp"),
    )


# ------------------------------------------------------------------ pollution

@query("daily_pollution_by_country", polluted(ALLOWED) + """
SELECT CAST(date AS VARCHAR) AS date, country, round(coalesce(sum(pollution), 0), 3) AS pollution FROM poll GROUP BY ALL""")
def _(fx):
    return rounded(pollution_plan.daily_pollution(polluted_rows(fx)), pollution=3)


@query("pollution_by_country", polluted(ALLOWED) + """
SELECT country, round(coalesce(sum(pollution), 0), 3) AS pollution FROM poll GROUP BY country""")
def _(fx):
    return rounded(pollution_plan.pollution_by_country(polluted_rows(fx)), pollution=3)


@query("pollution_summary", polluted(ALLOWED) + """
SELECT country, round(coalesce(sum(pollution), 0), 3) AS total_pollution_kg, round((SELECT sum(time_diff) FROM poll), 4) AS total_hours,
 round((SELECT sum(pollution) / sum(time_diff) FROM poll), 5) AS avg_hourly_rate_kg_per_hour FROM poll GROUP BY country""")
def _(fx):
    summary = pollution_plan.pollution_summary(polluted_rows(fx))
    return rounded(summary, total_pollution_kg=3, total_hours=4, avg_hourly_rate_kg_per_hour=5)


@query("pollution_iso_rules", polluted(ISO_ALLOWED) + """
SELECT country, count(*) AS reports, count(*) FILTER (WHERE NOT discharge_allowed) AS blocked, round(coalesce(sum(pollution), 0), 3) AS pollution
FROM poll GROUP BY country""")
def _(fx):
    rows = pollution_plan.pollution(augmented(fx), fx.ports, country_rules=ISO, land=land(fx))
    by_country = rows.groupBy("country").agg(
        F.count(F.lit(1)).alias("reports"), F.count_if(~F.col("discharge_allowed")).alias("blocked"),
        F.coalesce(F.sum("pollution"), F.lit(0.0)).alias("pollution"),
    )
    return rounded(by_country, pollution=3)


@query("discharge_allowed", polluted(ISO_ALLOWED) + "SELECT id, discharge_allowed FROM poll")
def _(fx):
    placed = augmented(fx).select("id", "latitude", "longitude", "operation_mode")
    return pollution_plan.discharge_allowed(placed, fx.ports, country_rules=ISO, land=land(fx)).select("id", "discharge_allowed")


@query("emission_for_interval", polluted(ALLOWED) + """
SELECT id, round(time_diff, 6) AS time_diff, round(pollution, 4) AS pollution FROM poll""")
def _(fx):
    return rounded(polluted_rows(fx).select("id", "time_diff", "pollution"), time_diff=6, pollution=4)


# ---------------------------------------------------------------- extract jobs

@query("scrubber_flag", given("fx_ships", "fx_scrubbers") + """
SELECT s.imo_number, c.imo_number IS NOT NULL AS has_scrubber FROM fx_ships s
LEFT JOIN fx_scrubbers c ON CAST(s.imo_number AS VARCHAR) = c.imo_number""")
def _(fx):
    return lookups.scrubber_flag(fx.ships, fx.scrubbers).select("imo_number", "has_scrubber")


@query("ship_stats", given("stats") + f"""
SELECT imo_number, name, ship_type, has_scrubber, position_count, round(avg_speed, 10) AS avg_speed, {ts('first_seen')} AS first_seen,
 {ts('last_seen')} AS last_seen, unique_destinations FROM stats""")
def _(fx):
    return rounded(extract_plan.ship_stats(fx.ships, fx.positions, fx.scrubbers), avg_speed=10)


@query("ship_stats_duplicate_list", given("stats") + """
SELECT imo_number, position_count * CASE WHEN has_scrubber THEN 2 ELSE 1 END AS position_count, unique_destinations FROM stats""")
def _(fx):
    twice = fx.scrubbers.unionByName(fx.scrubbers)
    return extract_plan.ship_stats(fx.ships, fx.positions, twice).select("imo_number", "position_count", "unique_destinations")


SAMPLED = given("fx_positions", "fx_ships", "fx_scrubbers") + f"""
, chunked AS (SELECT *, CAST(floor(epoch(timestamp_collected - TIMESTAMP '2024-01-01') / 604800) AS INTEGER) AS chunk FROM fx_positions
 WHERE timestamp_collected >= TIMESTAMP '2024-01-01' AND timestamp_collected < TIMESTAMP '2024-01-27'),
cstats AS (SELECT p.chunk, s.imo_number, s.name, s.ship_type, c.imo_number IS NOT NULL AS has_scrubber, count(*) AS position_count,
 avg(p.sog) AS avg_speed, min(timestamp_collected) AS first_seen, max(timestamp_collected) AS last_seen, count(DISTINCT destination) AS unique_destinations
 FROM fx_ships s LEFT JOIN fx_scrubbers c ON CAST(s.imo_number AS VARCHAR) = c.imo_number JOIN chunked p ON p.imo_number = s.imo_number
 GROUP BY p.chunk, s.imo_number, s.name, s.ship_type, c.imo_number),
numbered AS (SELECT *, row_number() OVER (PARTITION BY chunk, imo_number ORDER BY timestamp_collected, id) AS rn FROM chunked)
SELECT s.imo_number, s.name, s.ship_type, s.has_scrubber, s.position_count, round(s.avg_speed, 10) AS avg_speed, {ts('s.first_seen')} AS first_seen,
 {ts('s.last_seen')} AS last_seen, s.unique_destinations, n.latitude, n.longitude, n.sog, n.cog, n.navigational_status_code,
 {ts('n.timestamp_collected')} AS timestamp_collected, n.destination
FROM numbered n JOIN cstats s ON s.chunk = n.chunk AND s.imo_number = n.imo_number WHERE n.rn % 3 = 1"""


@query("sampled_extract", SAMPLED)
def _(fx):
    sampled = extract_plan.sampled_extract(fx.ships, fx.positions, fx.scrubbers, "2024-01-01", "2024-01-27", 7, every=3)
    return rounded(sampled, avg_speed=10)


@query("sampled_extract_split_keys", SAMPLED)
def _(fx):
    sampled = extract_plan.sampled_extract(
        fx.ships, fx.positions, fx.scrubbers, "2024-01-01", "2024-01-27", 7, every=3, piece_rows=3
    )
    return rounded(sampled, avg_speed=10)


@query("augment_emissions", given("aug") + """
SELECT id, operation_mode, emission_berth, emission_anchor, emission_maneuver, emission_cruise FROM aug""")
def _(fx):
    from tidewake.functions.ais import operation_mode

    with_mode = extract(fx).withColumn("operation_mode", operation_mode(F.col("navigational_status_code")))
    stale = with_mode.withColumn("emission_berth", F.lit(-1.0))
    return lookups.augment_emissions(stale, fx.ships).select("id", "operation_mode", *lookups.EMISSIONS)


@query("emission_coverage", given("aug") + """
SELECT count(DISTINCT imo_number) AS ships_with_emissions FROM aug WHERE emission_berth IS NOT NULL""")
def _(fx):
    return lookups.emission_coverage(augmented(fx))


# ---------------------------------------------------------------------- joins

@query("merge_suffix", given("fx_scrubbers", "fx_ships") + """
SELECT c.imo_number, c.sox_scrubber_status, CAST(s.length AS INTEGER) AS length, CASE WHEN s.imo_number % 2 = 0 THEN 'Fitted' ELSE 'Planned' END AS sox_scrubber_status_wfr
FROM fx_scrubbers c JOIN fx_ships s ON c.imo_number = CAST(s.imo_number AS VARCHAR)""")
def _(fx):
    second = fx.ships.select(
        "imo_number", "length", F.when(F.col("imo_number") % 2 == 0, "Fitted").otherwise("Planned").alias("sox_scrubber_status")
    )
    return lookups.merge_with_suffix(fx.scrubbers, second, "imo_number")


@query("eda_merge", given("fx_positions", "fx_ships") + """
SELECT p.id, s.name, s.ship_type, p.destination, t.port_id, t.country FROM fx_positions p
LEFT JOIN fx_ships s ON s.imo_number = p.imo_number LEFT JOIN fx_ports t ON t.port_name = upper(trim(p.destination))""")
def _(fx):
    named = fx.positions.withColumn("destination", F.upper(F.trim("destination")))
    merged = profile.merge_ship_and_port(named, fx.ships, fx.ports).select("id", "name", "ship_type", "port_id", "country")
    return merged.join(fx.positions.select("id", "destination"), "id").select("id", "name", "ship_type", "destination", "port_id", "country")


BANNED = given("fx_positions", "fx_port_bans") + """
, banned AS (SELECT p.id, coalesce(b.scrubber_status, 0) AS scrubber_status FROM fx_positions p
 LEFT JOIN fx_port_bans b ON b.port_name = upper(trim(p.destination)))
"""


def destination_bans(fx):
    key = F.upper(F.trim("destination"))
    return lookups.lookup_with_default(fx.positions, key, fx.port_bans, "port_name", {"scrubber_status": 0})


@query("lookup_default", BANNED + "SELECT id, scrubber_status FROM banned")
def _(fx):
    return destination_bans(fx).select("id", "scrubber_status")


@query("semi_filter", given("fx_positions", "fx_scrubbers") + """
SELECT id FROM fx_positions WHERE CAST(imo_number AS VARCHAR) IN (SELECT imo_number FROM fx_scrubbers)""")
def _(fx):
    listed = fx.scrubbers.select(F.col("imo_number").cast("bigint").alias("imo_number"))
    return lookups.semi_filter(fx.positions, listed, "imo_number").select("id")


@query("anti_filter", given("fx_positions") + """
SELECT id, destination FROM fx_positions WHERE destination IS NULL OR destination NOT IN ('NLRTM', 'OSLO')""")
def _(fx):
    unwanted = fx.positions.where(F.col("destination").isin("NLRTM", "OSLO")).select("destination").distinct()
    return lookups.anti_filter(fx.positions, unwanted, "destination").select("id", "destination")


@query("scrubber_split", given("fx_ships", "fx_scrubbers") + """
SELECT s.imo_number, coalesce(c.sox_scrubber_status, 'Non-Scrubber') AS scrubber_status FROM fx_ships s
LEFT JOIN fx_scrubbers c ON CAST(s.imo_number AS VARCHAR) = c.imo_number""")
def _(fx):
    listed = fx.scrubbers.withColumnRenamed("imo_number", "IMO Number")
    return lookups.scrubber_split(fx.ships, listed, list_key="IMO Number").select("imo_number", "scrubber_status")


ASOF = given("fx_positions") + """
SELECT l.id, r.destination AS recent_destination FROM (SELECT * FROM fx_positions WHERE id % 4 <> 0) l
LEFT JOIN (SELECT * FROM (SELECT a.id AS lid, b.destination, row_number() OVER (PARTITION BY a.id ORDER BY b.timestamp_ais DESC, b.id DESC) AS rn
 FROM fx_positions a JOIN fx_positions b ON a.imo_number = b.imo_number AND b.id % 4 = 0 AND a.id % 4 <> 0
  AND b.timestamp_ais <= a.timestamp_ais AND b.timestamp_ais > a.timestamp_ais - INTERVAL 5 HOUR) WHERE rn = 1) r ON r.lid = l.id"""


def asof(fx, **kwargs):
    left, right = fx.positions.where("id % 4 <> 0"), fx.positions.where("id % 4 = 0")
    found = temporal.asof_latest_within(left, right, "imo_number", "timestamp_ais", "id", "destination", 5 * 3600, **kwargs)
    return found.select("id", "recent_destination")


@query("asof_destination", ASOF)
def _(fx):
    return asof(fx)


@query("asof_destination_split_keys", ASOF)
def _(fx):
    return asof(fx, piece_rows=3)


@query("latest_recent_destination", given("fx_positions") + """
SELECT imo_number, arg_max(coalesce(destination, '-'), (timestamp_ais, id)) AS destination FROM fx_positions
WHERE timestamp_ais > TIMESTAMP '2024-01-20 12:00:00' - INTERVAL 5 HOUR AND timestamp_ais <= TIMESTAMP '2024-01-20 12:00:00' GROUP BY imo_number""")
def _(fx):
    named = fx.positions.withColumn("destination", F.coalesce("destination", F.lit("-")))
    return temporal.latest_within(named, "imo_number", "timestamp_ais", "id", "destination", "2024-01-20 12:00:00", 5)


IDENTITY = given("named") + "SELECT seq, mmsi, imo_number FROM named"


def identity(fx, **kwargs):
    routed = stored_messages(fx)
    reports = routed.where(F.col("route") == "position").select("seq", "mmsi", "timestamp_ais")
    stored = fx.ships.where("mmsi % 2 = 0")
    return lookups.resolve_identity(reports, statics(fx, routed), stored, **kwargs).select("seq", "mmsi", "imo_number")


@query("resolve_identity", IDENTITY)
def _(fx):
    return identity(fx)


@query("resolve_identity_split_keys", IDENTITY)
def _(fx):
    return identity(fx, piece_rows=3)


# -------------------------------------------------------------------- windows

GAPS = given("fx_positions") + """
SELECT id, round(date_diff('microsecond', lag(timestamp_collected) OVER (PARTITION BY imo_number ORDER BY timestamp_collected, id),
 timestamp_collected) / 3600e6, 6) AS time_diff FROM fx_positions"""


@query("time_gap_hours", GAPS)
def _(fx):
    return rounded(temporal.hours_since_previous(fx.positions).select("id", "time_diff"), time_diff=6)


@query("time_gap_hours_split_keys", GAPS)
def _(fx):
    return rounded(temporal.hours_since_previous(fx.positions, piece_rows=3).select("id", "time_diff"), time_diff=6)


@query("systematic_sample", given("fx_positions") + """
SELECT id, imo_number FROM (SELECT *, row_number() OVER (PARTITION BY imo_number ORDER BY timestamp_collected, id) AS rn FROM fx_positions) WHERE rn % 10 = 1""")
def _(fx):
    return temporal.systematic_sample(fx.positions, ["imo_number"], "timestamp_collected", 10).select("id", "imo_number")


@query("latest_state", given("fx_positions") + f"""
SELECT imo_number, arg_max(latitude, (timestamp_collected, id)) FILTER (WHERE latitude IS NOT NULL) AS latitude,
 arg_max(destination, (timestamp_collected, id)) FILTER (WHERE destination IS NOT NULL) AS destination,
 arg_max(navigational_status_code, (timestamp_collected, id)) FILTER (WHERE navigational_status_code IS NOT NULL) AS navigational_status_code,
 {ts('max(timestamp_collected)')} AS timestamp_collected FROM fx_positions GROUP BY imo_number""")
def _(fx):
    state = temporal.latest_state(fx.positions, "imo_number", ["timestamp_collected", "id"])
    return state.select("imo_number", "latitude", "destination", "navigational_status_code", "timestamp_collected")


DEDUP_KEYS = [
    "imo_number", "timestamp_ais", "latitude", "longitude", "destination", "sog", "cog", "navigational_status_code", "true_heading",
]


@query("dedup_reports", given("fx_positions") + f"SELECT id, {ts('timestamp_collected')} AS timestamp_collected, destination FROM fx_positions")
def _(fx):
    return temporal.dedup_reports(fx.duplicated, DEDUP_KEYS).select("id", "timestamp_collected", "destination")


@query("first_per_ship", given("fx_positions") + """
SELECT imo_number, arg_min(id, (timestamp_collected, id)) AS id FROM fx_positions GROUP BY imo_number""")
def _(fx):
    return temporal.first_per_key(fx.positions, ["imo_number"], ["timestamp_collected", "id"]).select("imo_number", "id")


@query("work_queue", given("fx_ships") + """
SELECT imo_number, ship_type FROM fx_ships WHERE ship_type IS NULL OR trim(ship_type) = '' ORDER BY imo_number LIMIT 25""")
def _(fx):
    pending = F.col("ship_type").isNull() | (F.trim("ship_type") == "")
    return temporal.oldest_unprocessed(fx.ships, pending, ["imo_number"], 25).select("imo_number", "ship_type")


@query("work_queue_distinct", given("fx_ships") + """
SELECT DISTINCT ON (length) imo_number, length FROM fx_ships WHERE ship_type IS NULL OR trim(ship_type) = '' ORDER BY length, imo_number LIMIT 10""")
def _(fx):
    pending = F.col("ship_type").isNull() | (F.trim("ship_type") == "")
    waiting = fx.ships.where("imo_number IS NOT NULL")
    return temporal.oldest_unprocessed(waiting, pending, ["length", "imo_number"], 10, distinct=["length"]).select("imo_number", "length")


@query("work_queue_positions", given("fx_positions") + """
SELECT id, imo_number FROM fx_positions WHERE navigational_status_code IS NULL ORDER BY timestamp_ais, id LIMIT 50""")
def _(fx):
    pending = F.col("navigational_status_code").isNull()
    return temporal.oldest_unprocessed(fx.positions, pending, ["timestamp_ais", "id"], 50).select("id", "imo_number")


# ----------------------------------------------------------------- aggregates

@query("type_distribution", given("ext") + """
SELECT ship_type, count(DISTINCT imo_number) AS ships, CAST(sum(position_count) AS BIGINT) AS position_count FROM ext
WHERE ship_type IS NOT NULL GROUP BY ship_type""")
def _(fx):
    return aggregate.type_distribution(extract(fx))


@query("position_weight", given("ext") + """
SELECT ship_type, has_scrubber, CAST(sum(position_count) AS BIGINT) AS position_count FROM ext
WHERE ship_type IS NOT NULL GROUP BY ship_type, has_scrubber""")
def _(fx):
    return aggregate.position_weight(extract(fx))


@query("top_destinations", given("fx_positions") + """
SELECT destination, count(*) AS n FROM fx_positions WHERE destination IS NOT NULL GROUP BY destination ORDER BY n DESC, destination LIMIT 10""")
def _(fx):
    return aggregate.top_values(fx.positions, "destination", 10)


@query("top_categories", given("ext") + """
SELECT ship_type, count(*) AS n FROM ext WHERE ship_type IS NOT NULL GROUP BY ship_type ORDER BY n DESC, ship_type LIMIT 5""")
def _(fx):
    return aggregate.top_values(extract(fx), "ship_type", 5)


@query("value_counts", given("norm") + """
SELECT 'destination' AS kind, destination AS value, count(*) AS n FROM norm WHERE destination IS NOT NULL GROUP BY destination
UNION ALL SELECT 'secondary', secondary_destination, count(*) FROM norm WHERE secondary_destination IS NOT NULL GROUP BY secondary_destination""")
def _(fx):
    normalized = normalize_destinations(fx.positions)

    def counted(column, kind):
        return aggregate.top_values(normalized, column).select(F.lit(kind).alias("kind"), F.col(column).alias("value"), "n")

    return counted("destination", "destination").unionByName(counted("secondary_destination", "secondary"))


@query("distinct_keys", given("ext") + "SELECT DISTINCT imo_number FROM ext WHERE has_scrubber")
def _(fx):
    return extract(fx).where("has_scrubber").select("imo_number").distinct()


@query("hourly_activity", given("fx_positions") + """
SELECT CAST(hour(timestamp_collected) AS INTEGER) AS hour, count(*) AS n FROM fx_positions GROUP BY 1""")
def _(fx):
    return aggregate.hourly_activity(fx.positions)


@query("daily_unique_pivot", given("ext") + """
SELECT CAST(CAST(timestamp_collected AS DATE) AS VARCHAR) AS date, count(DISTINCT imo_number) FILTER (WHERE NOT has_scrubber) AS non_scrubber,
 count(DISTINCT imo_number) FILTER (WHERE has_scrubber) AS scrubber FROM ext GROUP BY 1""")
def _(fx):
    return aggregate.daily_unique_pivot(extract(fx))


@query("daily_ship_counts", given("fx_positions") + """
SELECT CAST(CAST(timestamp_collected AS DATE) AS VARCHAR) AS date, count(DISTINCT imo_number) AS ships FROM fx_positions
WHERE latitude BETWEEN 51 AND 61 AND longitude BETWEEN -4 AND 9 GROUP BY 1""")
def _(fx):
    return aggregate.daily_ship_counts(profile.study_area(fx.positions))


@query("global_stats", given("fx_positions") + """
SELECT count(DISTINCT imo_number) AS ships, count(*) AS positions, round(avg(sog), 10) AS avg_speed FROM fx_positions""")
def _(fx):
    return rounded(aggregate.global_stats(fx.positions), avg_speed=10)


POSITION_COLUMNS = (
    "id", "imo_number", "mmsi", "timestamp_collected", "timestamp_ais", "latitude", "longitude", "destination", "sog", "cog",
    "navigational_status_code", "true_heading",
)


@query("null_census", given("fx_positions") + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM fx_positions"
    for c in POSITION_COLUMNS))
def _(fx):
    return aggregate.null_census(fx.positions)


@query("status_distribution", BANNED + "SELECT scrubber_status, count(*) AS n FROM banned GROUP BY scrubber_status")
def _(fx):
    return aggregate.code_distribution(destination_bans(fx), "scrubber_status")


@query("unprocessed_counts", given("fx_ships", "fx_ship_type_codes", "fx_positions") + """
SELECT 'positions' AS kind, count(*) AS total_records, count(*) FILTER (WHERE id % 3 <> 0) AS unprocessed_records FROM fx_positions
UNION ALL SELECT 'ships', count(*) AS total_records, count(*) FILTER (WHERE t.type_code IS NOT NULL AND t.remark IS NULL) AS unprocessed_records FROM fx_ships s
LEFT JOIN fx_ship_type_codes t ON t.type_code = CAST(trunc(TRY_CAST(trim(s.ship_type) AS DOUBLE)) AS INTEGER)""")
def _(fx):
    enriched = lookups.enrich_ships(fx.ships, fx.ship_type_codes)
    partly = fx.positions.withColumn("navigational_status", F.when(F.col("id") % 3 == 0, "done"))
    ships = aggregate.unprocessed_counts(enriched, ["type_name", "type_remark"]).withColumn("kind", F.lit("ships"))
    return ships.unionByName(aggregate.unprocessed_counts(partly, ["navigational_status"]).withColumn("kind", F.lit("positions")))


@query("retention_audit", given("fx_positions") + f"""
SELECT count(*) AS total, count(*) FILTER (WHERE i) AS kept, count(*) - count(*) FILTER (WHERE i) AS deleted, round(count(*) FILTER (WHERE i) * 100e0 / count(*), 6) AS kept_percent,
 round((count(*) - count(*) FILTER (WHERE i)) * 100e0 / count(*), 6) AS deleted_percent FROM (SELECT {in_region('latitude', 'longitude')} AS i FROM fx_positions)""")
def _(fx):
    return rounded(keep_region(fx.positions, region(fx), dry_run=True)[1], kept_percent=6, deleted_percent=6)


@query("keep_region", given("fx_positions") + f"SELECT id, imo_number FROM fx_positions WHERE {in_region('latitude', 'longitude')}")
def _(fx):
    return keep_region(fx.positions, region(fx))[0].select("id", "imo_number")


@query("coverage_metrics", given("routed", "named") + """
, used AS (SELECT r.mmsi, r.route, CASE WHEN r.route = 'position' THEN n.imo_number ELSE r.raw_imo END AS imo FROM routed r LEFT JOIN named n ON n.seq = r.seq)
SELECT count(*) FILTER (WHERE route IN ('static', 'position', 'no_imo')) AS collected, count(*) FILTER (WHERE route = 'outside') AS filtered, count(*) FILTER (WHERE route = 'static') AS static_data,
 count(*) FILTER (WHERE route = 'position' AND imo > 0) AS position_data, count(*) FILTER (WHERE route IN ('static', 'position', 'no_imo') AND coalesce(imo, 0) <= 0) AS no_imo,
 count(DISTINCT mmsi) FILTER (WHERE route IN ('static', 'position', 'no_imo')) AS unique_vessels,
 count(DISTINCT mmsi) FILTER (WHERE route IN ('static', 'position', 'no_imo') AND imo > 0) AS vessels_with_imo,
 round(count(DISTINCT mmsi) FILTER (WHERE route IN ('static', 'position', 'no_imo') AND imo > 0) * 1e0
  / count(DISTINCT mmsi) FILTER (WHERE route IN ('static', 'position', 'no_imo')), 6) AS coverage FROM used""")
def _(fx):
    routed = stored_messages(fx)
    reports = routed.where(F.col("route") == "position").drop("imo_number")
    named = lookups.resolve_identity(reports, statics(fx, routed), fx.ships.where("mmsi % 2 = 0"))
    everything = routed.where(F.col("route") != "position").unionByName(named)
    return rounded(maintain.coverage_metrics(everything), coverage=6)


# ---------------------------------------------------------------------- flows

@query("flow_rows", given("ext") + """
SELECT has_scrubber, ship_type, destination, count(*) AS value FROM ext
WHERE ship_type IN (SELECT ship_type FROM ext WHERE ship_type IS NOT NULL GROUP BY ship_type ORDER BY count(*) DESC, ship_type LIMIT 5)
 AND destination IN (SELECT destination FROM ext WHERE destination IS NOT NULL GROUP BY destination ORDER BY count(*) DESC, destination LIMIT 5)
GROUP BY ALL""")
def _(fx):
    return aggregate.flow_rows(extract(fx))


FLOWS = given("next") + """
, grp AS (SELECT * FROM next WHERE has_scrubber),
tt AS (SELECT ship_type, row_number() OVER (ORDER BY count(*) DESC, ship_type) - 1 AS rk FROM grp WHERE ship_type IS NOT NULL GROUP BY ship_type
 ORDER BY count(*) DESC, ship_type LIMIT 5),
td AS (SELECT d AS destination, row_number() OVER (ORDER BY count(*) DESC, d) - 1 AS rk FROM
 (SELECT destination AS d FROM grp UNION ALL SELECT secondary_destination FROM grp) WHERE d IS NOT NULL GROUP BY d ORDER BY count(*) DESC, d LIMIT 5),
legs AS (SELECT 'primary' AS leg, ship_type, destination, imo_number FROM grp UNION ALL SELECT 'secondary', ship_type, secondary_destination, imo_number FROM grp),
flows AS (SELECT l.leg, l.ship_type, l.destination, tt.rk AS s, td.rk AS t, count(DISTINCT l.imo_number) AS value
 FROM legs l JOIN tt ON tt.ship_type = l.ship_type JOIN td ON td.destination = l.destination GROUP BY ALL)
"""


def flows(fx, flag=True):
    return aggregate.flow_unique_ships(normalize_destinations(extract(fx)), flag)


@query("flow_unique_ships", FLOWS + "SELECT leg, ship_type, destination, value FROM flows")
def _(fx):
    return flows(fx)[0].select("leg", "ship_type", "destination", "value")


@query("flow_links", FLOWS + "SELECT s AS source, t + (SELECT count(*) FROM tt) AS target, value, leg FROM flows")
def _(fx):
    return aggregate.flow_links(*flows(fx))[1]


@query("flow_links_without_scrubber", FLOWS.replace("FROM next WHERE has_scrubber", "FROM next WHERE NOT has_scrubber") + """
SELECT s AS source, t + (SELECT count(*) FROM tt) AS target, value, leg FROM flows""")
def _(fx):
    return aggregate.flow_links(*flows(fx, False))[1]


@query("flow_nodes", FLOWS + """
SELECT rk AS node, upper(ship_type) AS label FROM tt UNION ALL SELECT rk + (SELECT count(*) FROM tt), destination FROM td""")
def _(fx):
    return aggregate.flow_links(*flows(fx))[0]


PROFILE = given("fx_positions", "fx_ships", "fx_ship_type_codes", "profiled") + """
, firsts AS (SELECT p.imo_number, arg_min(p.id, (p.timestamp_collected, p.id)) AS id FROM fx_positions p GROUP BY p.imo_number),
one AS (SELECT f.imo_number, t.type AS ship_type, d.destination FROM firsts f JOIN fx_ships s ON s.imo_number = f.imo_number
 LEFT JOIN fx_ship_type_codes t ON CAST(t.type_code AS VARCHAR) = s.ship_type JOIN profiled d ON d.id = f.id)
"""


def one_per_ship(fx):
    merged = profile.merge_ship_and_port(fx.positions, fx.ships, fx.ports)
    return profile.one_row_per_ship(merged, fx.ship_type_codes)


@query("profile_ships", PROFILE + "SELECT imo_number, ship_type, destination FROM one")
def _(fx):
    return one_per_ship(fx).select("imo_number", "ship_type", "destination")


@query("profile_flows", PROFILE + """
, kept AS (SELECT * FROM one WHERE destination IS DISTINCT FROM 'FISHING' AND ship_type IS DISTINCT FROM 'Other')
SELECT ship_type, destination, count(*) AS value FROM kept
WHERE ship_type IN (SELECT ship_type FROM kept WHERE ship_type IS NOT NULL GROUP BY ship_type ORDER BY count(*) DESC, ship_type LIMIT 5)
 AND destination IN (SELECT destination FROM kept WHERE destination IS NOT NULL GROUP BY destination ORDER BY count(*) DESC, destination LIMIT 5)
GROUP BY ALL""")
def _(fx):
    kept = lookups.exclude_rows(one_per_ship(fx), {"destination": "FISHING", "ship_type": "Other"})
    return aggregate.profile_flows(kept)


@query("profile_flow_links", PROFILE + """
, flagged AS (SELECT o.*, s.imo_number % 3 = 0 AS has_scrubber FROM one o JOIN fx_ships s ON s.imo_number = o.imo_number),
kept AS (SELECT * FROM flagged WHERE destination IS DISTINCT FROM 'FISHING' AND ship_type IS DISTINCT FROM 'Other'),
tt AS (SELECT has_scrubber, ship_type, row_number() OVER (PARTITION BY has_scrubber ORDER BY count(*) DESC, ship_type) - 1 AS rk FROM kept WHERE ship_type IS NOT NULL GROUP BY has_scrubber, ship_type QUALIFY rk < 5),
td AS (SELECT has_scrubber, destination, row_number() OVER (PARTITION BY has_scrubber ORDER BY count(*) DESC, destination) - 1 AS rk FROM kept WHERE destination IS NOT NULL GROUP BY has_scrubber, destination QUALIFY rk < 5)
SELECT k.has_scrubber, tt.rk AS source, td.rk + (SELECT count(*) FROM tt x WHERE x.has_scrubber = k.has_scrubber) AS target, count(*) AS value FROM kept k
JOIN tt ON tt.ship_type = k.ship_type AND tt.has_scrubber = k.has_scrubber JOIN td ON td.destination = k.destination AND td.has_scrubber = k.has_scrubber GROUP BY ALL""")
def _(fx):
    kept = lookups.exclude_rows(one_per_ship(fx), {"destination": "FISHING", "ship_type": "Other"})
    flagged = kept.withColumn("has_scrubber", F.col("imo_number") % 3 == 0)

    def links(flag):
        tables_ = aggregate.profile_flow_tables(flagged.where(F.col("has_scrubber") == flag))
        return aggregate.flow_links(*tables_)[1].select(F.lit(flag).alias("has_scrubber"), "source", "target", "value")

    return links(True).unionByName(links(False))


@query("stratified_sample", given("ext") + """
, hashed AS (SELECT id, ship_type, row_number() OVER (PARTITION BY ship_type ORDER BY md5(concat('42:', CAST(id AS VARCHAR))), id) AS rn,
 count(*) OVER (PARTITION BY ship_type) AS n FROM ext WHERE ship_type IN ('70', '80.0'))
SELECT id, ship_type FROM hashed WHERE rn <= round_even(n * CASE ship_type WHEN '70' THEN 0.13e0 ELSE 0.18e0 END, 0)""")
def _(fx):
    return aggregate.stratified_sample(extract(fx), "ship_type", {"80.0": 0.18, "70": 0.13}, "id").select("id", "ship_type")


@query("movement_report", given("ext") + """
SELECT 'totals' AS section, 'ships' AS key, count(DISTINCT imo_number) * 1e0 AS value FROM ext
UNION ALL SELECT 'totals', 'positions', count(*) FROM ext
UNION ALL SELECT 'totals', 'avg_speed', round(avg(sog), 10) FROM ext
UNION ALL SELECT 'ships_of_type', ship_type, count(DISTINCT imo_number) FROM ext WHERE ship_type IS NOT NULL GROUP BY ship_type
UNION ALL SELECT 'positions_of_type', ship_type, sum(position_count) FROM ext WHERE ship_type IS NOT NULL GROUP BY ship_type
UNION ALL (SELECT 'top_destinations', destination, count(*) FROM ext WHERE destination IS NOT NULL GROUP BY destination ORDER BY count(*) DESC, destination LIMIT 10)
UNION ALL SELECT 'hourly_activity', CAST(hour(timestamp_collected) AS VARCHAR), count(*) FROM ext GROUP BY hour(timestamp_collected)
UNION ALL SELECT 'flows', concat_ws(' | ', CASE WHEN has_scrubber THEN 'scrubber' ELSE 'non_scrubber' END, ship_type, destination), count(*) FROM ext
 WHERE ship_type IN (SELECT ship_type FROM ext WHERE ship_type IS NOT NULL GROUP BY ship_type ORDER BY count(*) DESC, ship_type LIMIT 5)
 AND destination IN (SELECT destination FROM ext WHERE destination IS NOT NULL GROUP BY destination ORDER BY count(*) DESC, destination LIMIT 5) GROUP BY has_scrubber, ship_type, destination
UNION ALL SELECT 'daily_non_scrubber', CAST(CAST(timestamp_collected AS DATE) AS VARCHAR), count(DISTINCT imo_number) FILTER (WHERE NOT has_scrubber) FROM ext GROUP BY 2
UNION ALL SELECT 'daily_scrubber', CAST(CAST(timestamp_collected AS DATE) AS VARCHAR), count(DISTINCT imo_number) FILTER (WHERE has_scrubber) FROM ext GROUP BY 2""")
def _(fx):
    return rounded(movement_report(stored_extract(fx)), value=10)


@query("destination_report", given("norm") + """
SELECT 'primary' AS section, destination AS key, count(*) * 1e0 AS value FROM norm WHERE destination IS NOT NULL GROUP BY destination
UNION ALL SELECT 'secondary', secondary_destination, count(*) FROM norm WHERE secondary_destination IS NOT NULL GROUP BY secondary_destination""")
def _(fx):
    return destination_report(normalize_destinations(fx.positions))


# ---------------------------------------------------------------- maintenance

@query("upsert_ships", given("master") + "SELECT * FROM master")
def _(fx):
    return maintain.upsert_ships(statics(fx))


@query("upsert_existing_ships", given("master", "fx_ships") + """
SELECT coalesce(m.imo_number, s.imo_number) AS imo_number, coalesce(s.mmsi, m.mmsi) AS mmsi,
 CASE WHEN m.imo_number IS NULL THEN s.name ELSE m.name END AS name, CASE WHEN m.imo_number IS NULL THEN s.length ELSE m.length END AS length,
 CASE WHEN m.imo_number IS NULL THEN s.width ELSE m.width END AS width
FROM (SELECT imo_number, mmsi + 5 AS mmsi, name, length, width FROM fx_ships WHERE imo_number % 2 = 0) s FULL JOIN master m ON m.imo_number = s.imo_number""")
def _(fx):
    existing = fx.ships.where("imo_number % 2 = 0").select(
        "imo_number", (F.col("mmsi") + 5).alias("mmsi"), "name", "ship_type", "length", "width", F.lit(1.0).alias("max_draught")
    )
    return maintain.upsert_ships(statics(fx), existing).select("imo_number", "mmsi", "name", "length", "width")


OLD_SHIPS = "(SELECT imo_number, length, width, imo_number % 5 = 0 AS done FROM fx_ships WHERE imo_number % 7 <> 0)"


@query("dimension_correction", given("fixes", "fx_ships") + f"""
SELECT s.imo_number, CASE WHEN f.imo_number IS NOT NULL AND NOT s.done THEN f.length ELSE s.length END AS length,
 CASE WHEN f.imo_number IS NOT NULL AND NOT s.done THEN f.width ELSE s.width END AS width,
 s.done OR f.imo_number IS NOT NULL AS lw_correction,
 CASE WHEN f.imo_number IS NOT NULL AND NOT s.done THEN {ts('f.timestamp_ais')} END AS lw_correction_timestamp
FROM {OLD_SHIPS} s LEFT JOIN fixes f ON f.imo_number = s.imo_number""")
def _(fx):
    return maintain.correct_dimensions(uncorrected_ships(fx), identified_statics(messages(fx))).drop("mmsi")


@query("correction_counters", given("fixes", "corrections", "fx_ships") + f"""
SELECT count(*) AS processed, count(*) FILTER (WHERE s.imo_number IS NOT NULL AND NOT s.done AND m.seq = f.seq) AS corrected,
 count(*) FILTER (WHERE s.imo_number IS NULL OR s.done OR coalesce(m.seq > f.seq, FALSE)) AS ignored
FROM corrections m LEFT JOIN {OLD_SHIPS} s ON s.imo_number = m.imo_number LEFT JOIN fixes f ON f.imo_number = m.imo_number""")
def _(fx):
    return maintain.correction_counters(uncorrected_ships(fx), identified_statics(stored_messages(fx)))


@query("guarded_enrichment", given("fx_positions", "fx_nav_status") + """
SELECT p.id, CASE WHEN p.id % 3 = 0 THEN 'kept' ELSE coalesce(s.navigational_status, 'Unknown') END AS navigational_status FROM fx_positions p
LEFT JOIN fx_nav_status s ON s.navigational_status_code = p.navigational_status_code""")
def _(fx):
    partly = fx.positions.withColumn("navigational_status", F.when(F.col("id") % 3 == 0, "kept"))
    return lookups.enrich_positions(partly, fx.nav_status).select("id", "navigational_status")


# ------------------------------------------------------------ sources and sinks

@query("reconcile_schema", given("fx_positions") + """
SELECT id, imo_number, CAST(NULL AS DOUBLE) AS rate_of_turn, FALSE AS lw_correction, sog FROM fx_positions""")
def _(fx):
    target = T.StructType([
        T.StructField("id", T.LongType()), T.StructField("imo_number", T.LongType()),
        T.StructField("rate_of_turn", T.DoubleType()), T.StructField("lw_correction", T.BooleanType()),
    ])
    return files.reconcile_schema(fx.positions.select("sog", "id", "imo_number"), target, {"lw_correction": False})


@query("reset_columns", given("fx_ships") + "SELECT imo_number, CAST(NULL AS VARCHAR) AS type_name, CAST(NULL AS VARCHAR) AS type_remark FROM fx_ships")
def _(fx):
    enriched = lookups.enrich_ships(fx.ships, fx.ship_type_codes)
    return files.reset_columns(enriched, ["type_name", "type_remark"]).select("imo_number", "type_name", "type_remark")


@query("clean_names", given("fx_ships") + "SELECT imo_number AS imo_number, length AS length_m, name AS ship_name FROM fx_ships")
def _(fx):
    raw = fx.ships.select(
        F.col("imo_number").alias(" IMO Number"), F.col("length").alias("Length (m)"), F.col("name").alias("Ship, Name ")
    )
    return files.clean_column_names(raw)


@query("coerce_ids", given("fx_positions") + """
SELECT id, CASE WHEN id % 4 = 0 THEN 0 ELSE imo_number END AS imo_number, coalesce(CASE WHEN id % 5 <> 0 THEN mmsi END, 0) AS mmsi, CAST(sog AS DOUBLE) AS sog FROM fx_positions""")
def _(fx):
    raw = fx.positions.select(
        "id", F.when(F.col("id") % 4 != 0, F.col("imo_number").cast("double")).otherwise(F.lit(float("nan"))).alias("imo_number"),
        F.when(F.col("id") % 5 != 0, F.col("mmsi")).alias("mmsi"), "sog",
    )
    return files.coerce_identifier_columns(raw)


@query("csv_round_trip", given("fx_daily") + "SELECT CAST(date AS VARCHAR) AS date, country, pollution FROM fx_daily")
def _(fx):
    path = shared_dir(fx.spark, "csv")
    files.write_csv(fx.daily, path)
    return files.read_reference_csv(fx.spark, path, schemas.DAILY_POLLUTION)


@query("extract_round_trip", given("fx_positions") + f"""
SELECT id, imo_number, {ts('timestamp_collected')} AS timestamp_collected, destination FROM fx_positions
WHERE timestamp_collected >= TIMESTAMP '2024-01-10' AND timestamp_collected < TIMESTAMP '2024-01-12'""")
def _(fx):
    path = shared_dir(fx.spark, "extract")
    files.write_extract(fx.positions.select("id", "imo_number", "timestamp_collected", "destination"), path)
    stored = files.read_extract(fx.spark, path)
    return stored.where(F.col("date").between("2024-01-10", "2024-01-11")).drop("date")


@query("table_round_trip", given("fx_ships") + "SELECT imo_number, name, length FROM fx_ships UNION ALL SELECT imo_number, name, length FROM fx_ships WHERE length > 100")
def _(fx):
    path = shared_dir(fx.spark, "ships_table")
    name = "tidewake_" + path.rsplit("-", 1)[1]
    tables.save_table(fx.ships.select("imo_number", "name", "length"), name, "overwrite", path)
    tables.save_table(fx.ships.where("length > 100").select("imo_number", "name", "length"), name, "append")
    return tables.load_table(fx.spark, name, require=("imo_number",))


@query("scrubber_lists", given("fx_scrubbers", "fx_ships") + """
SELECT c.imo_number, c.sox_scrubber_status, s.name AS name FROM fx_scrubbers c JOIN fx_ships s ON c.imo_number = CAST(s.imo_number AS VARCHAR)""")
def _(fx):
    path = shared_dir(fx.spark, "combined")
    name = "tidewake_" + path.rsplit("-", 1)[1]
    tables.save_table(lookups.merge_with_suffix(fx.scrubbers, fx.ships.select("imo_number", "name"), "imo_number"), name, path=path)
    return fx.spark.read.table(name)


@query("latest_positions", given("ext") + """
SELECT imo_number, bool_or(has_scrubber) AS has_scrubber, arg_max(latitude, (timestamp_collected, id)) FILTER (WHERE latitude IS NOT NULL) AS latitude,
 arg_max(longitude, (timestamp_collected, id)) FILTER (WHERE longitude IS NOT NULL) AS longitude FROM ext GROUP BY imo_number""")
def _(fx):
    with_flag, without = latest_positions(extract(fx))
    columns = ["imo_number", "has_scrubber", "latitude", "longitude"]
    return with_flag.select(*columns).unionByName(without.select(*columns))


@query("table_preview", given("fx_ships") + """
SELECT (SELECT count(*) FROM fx_ships) AS total, imo_number, name, ship_type, length FROM fx_ships ORDER BY imo_number LIMIT 5""")
def _(fx):
    path = shared_dir(fx.spark, "ships_table")
    name = "tidewake_" + path.rsplit("-", 1)[1]
    tables.save_table(fx.ships, name, path=path)
    total, preview = tables.verify_table(fx.spark, name, 5, "imo_number")
    return preview.select(F.lit(total).cast("bigint").alias("total"), "imo_number", "name", "ship_type", "length")


def by_day(fx, rows):
    """The rows as a catalog table by day of their message time."""
    path = shared_dir(fx.spark, "by_day")
    name = "tidewake_" + path.rsplit("-", 1)[1]
    dated = rows.withColumn("day", F.date_format("timestamp_ais", "yyyy-MM-dd"))
    dated.write.partitionBy("day").option("path", path).saveAsTable(name)
    return name


@query("delete_outside_region", given("fx_positions") + f"SELECT id FROM fx_positions WHERE {in_region('latitude', 'longitude')}")
def _(fx):
    name = by_day(fx, fx.positions)
    writeback.delete_outside(fx.spark, name, "day", region(fx), at_a_time=4)
    return fx.spark.read.table(name).select("id")


@query("delete_outside_audit", given("fx_positions") + f"""
SELECT strftime(timestamp_ais, '%Y-%m-%d') AS day, count(*) AS total, count(*) FILTER (WHERE {in_region('latitude', 'longitude')}) AS kept,
 count(*) FILTER (WHERE NOT {in_region('latitude', 'longitude')}) AS deleted FROM fx_positions GROUP BY ALL""")
def _(fx):
    return writeback.delete_outside(fx.spark, by_day(fx, fx.positions), "day", region(fx), dry_run=True)


@query("region_from_geojson", given("fx_positions") + f"SELECT id, {in_region('latitude', 'longitude')} AS in_region FROM fx_positions")
def _(fx):
    """The region written as a GeoJSON file and read back."""
    corner = F.sort_array(F.collect_list(F.struct("seq", "lon", "lat")))
    ring = F.transform(corner, lambda p: F.array(p["lon"], p["lat"]))
    shapes = fx.region.groupBy("region_id").agg(F.array(ring).alias("coordinates")).select(
        F.struct(F.struct(F.lit("Polygon").alias("type"), "coordinates").alias("geometry")).alias("feature"))
    file = shapes.agg(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), F.collect_list("feature").alias("features"))).alias("value"))
    path = shared_dir(fx.spark, "geojson")
    file.coalesce(1).write.text(path)
    return within_region(fx.positions, read_rings(fx.spark, path)).select("id", "in_region")


@query("region_from_feature_lines", given("fx_positions") + f"SELECT id, {in_region('latitude', 'longitude')} AS in_region FROM fx_positions")
def _(fx):
    """The same region with a feature per line, in as many files as there are tasks."""
    corner = F.sort_array(F.collect_list(F.struct("seq", "lon", "lat")))
    ring = F.transform(corner, lambda p: F.array(p["lon"], p["lat"]))
    shapes = fx.region.groupBy("region_id").agg(F.array(ring).alias("coordinates"))
    path = shared_dir(fx.spark, "features")
    shapes.select(F.to_json(F.struct(F.struct(F.lit("Polygon").alias("type"), "coordinates").alias("geometry"))).alias("value")).write.text(path)
    return within_region(fx.positions, read_rings(fx.spark, path, lines=True)).select("id", "in_region")


def reference_folder(fx):
    """Reference tables as CSV, with reordered and upper-case headers."""
    path = shared_dir(fx.spark, "reference")
    files.write_csv(fx.part_codes.select("remark", "type", "type_code"), path + "/ship_type_codes.csv")
    ports = fx.harbours.select("country", "port_name", "latitude", "longitude", "port_id")
    files.write_csv(ports.toDF(*[c.upper() for c in ports.columns]), path + "/ports.csv")
    files.write_csv(fx.harbour_bans, path + "/port_bans.csv")
    return path


@query("reference_tables", given("fx_harbours", "fx_harbour_bans") + """
SELECT p.port_id, p.port_name, p.country, p.latitude, coalesce(b.scrubber_status, 0) AS scrubber_status FROM fx_harbours p LEFT JOIN fx_harbour_bans b ON b.port_name = p.port_name""")
def _(fx):
    path = reference_folder(fx)
    prefix = "tidewake_" + path.rsplit("-", 1)[1] + "_"
    tables.load_reference_tables(fx.spark, path, "update", prefix, path + "/tables")
    return fx.spark.read.table(prefix + "ports").select("port_id", "port_name", "country", "latitude", "scrubber_status")


@query("reference_statuses", given("fx_positions") + f"""
SELECT s.code AS navigational_status_code, s.status AS navigational_status, count(p.id) AS n FROM (VALUES {STATUS_ROWS}) s(code, status)
LEFT JOIN fx_positions p ON p.navigational_status_code = s.code GROUP BY s.code, s.status""")
def _(fx):
    """All loaded statuses, and how many reports have them."""
    path = reference_folder(fx)
    prefix = "tidewake_" + path.rsplit("-", 1)[1] + "_"
    tables.load_reference_tables(fx.spark, path, "update", prefix, path + "/tables")
    counts = fx.positions.groupBy("navigational_status_code").agg(F.count(F.lit(1)).alias("n"))
    statuses = fx.spark.read.table(prefix + "navigational_status").join(counts, "navigational_status_code", "left")
    return statuses.select("navigational_status_code", "navigational_status", F.coalesce("n", F.lit(0)).alias("n"))


@query("reference_tables_audit", given("fx_part_codes") + """
SELECT 'nulls' AS kind, 'type_code' AS name, 0 AS n UNION ALL SELECT 'nulls', 'type', 0 UNION ALL SELECT 'nulls', 'remark', count(*) FILTER (WHERE remark IS NULL) FROM fx_part_codes
UNION ALL SELECT 'type_code', CAST(type_code AS VARCHAR), count(*) FROM fx_part_codes GROUP BY type_code""")
def _(fx):
    read = files.read_reference_csv(fx.spark, reference_folder(fx) + "/ship_type_codes.csv", schemas.SHIP_TYPE_CODES)
    return tables.load_audit(read, "type_code")


@query("load_if_absent", given("fx_ships") + "SELECT imo_number, 'recreated' AS made FROM fx_ships WHERE length > 100 UNION ALL SELECT imo_number, 'kept' FROM fx_ships")
def _(fx):
    def loaded(second_mode, label):
        path = shared_dir(fx.spark, "loaded")
        name = "tidewake_" + path.rsplit("-", 1)[1]
        tables.load_if_absent(fx.spark, name, lambda: fx.ships.select("imo_number"), path=path)
        tables.load_if_absent(fx.spark, name, lambda: fx.ships.where("length > 100").select("imo_number"), second_mode, path)
        return fx.spark.read.table(name).withColumn("made", F.lit(label))

    return loaded("update", "kept").unionByName(loaded("recreate", "recreated"))


@query("exported_tables", given("fx_ships") + "SELECT imo_number, name, length FROM fx_ships WHERE length > 100")
def _(fx):
    """A table of a database of its own, exported with all others there and read back."""
    path, before = shared_dir(fx.spark, "exported"), fx.spark.catalog.currentDatabase()
    name = "tidewake_" + path.rsplit("-", 1)[1]
    fx.spark.sql(f"CREATE DATABASE {name} LOCATION '{path}/database'")
    try:
        fx.spark.catalog.setCurrentDatabase(name)
        tables.save_table(fx.ships.where("length > 100").select("imo_number", "name", "length"), "ships")
        tables.export_all_tables(fx.spark, f"{path}/files")
    finally:
        fx.spark.catalog.setCurrentDatabase(before)
    kinds = T.StructType([f for f in schemas.SHIPS.fields if f.name in ("imo_number", "name", "length")])
    return files.read_reference_csv(fx.spark, f"{path}/files/ships", kinds).select("imo_number", "name", "length")


@query("port_coordinates", given("fx_harbours") + """
SELECT upper(port_name) AS port_name, arg_max(latitude, port_id) AS latitude, upper(arg_max(country, port_id)) AS country FROM
 (SELECT port_id, port_name, country, latitude FROM fx_harbours UNION ALL SELECT port_id + 1000000, lower(port_name), lower(country), latitude + 1 FROM fx_harbours WHERE port_id % 2 = 0)
GROUP BY upper(port_name)""")
def _(fx):
    again = fx.harbours.where("port_id % 2 = 0").select(
        (F.col("port_id") + 1000000).alias("port_id"), F.lower("port_name").alias("port_name"), F.lower("country").alias("country"),
        (F.col("latitude") + 1).alias("latitude"), "longitude")
    return tables.port_coordinates(fx.harbours.unionByName(again)).select("port_name", "latitude", "country")


@query("import_wide_ports", given("fx_harbours", "fx_harbour_bans") + """
SELECT CAST(p.port_id AS INTEGER) AS world_port_index_number, p.port_name, p.country, p.latitude, coalesce(b.scrubber_status, 0) AS scrubber_status
FROM fx_harbours p LEFT JOIN fx_harbour_bans b ON b.port_name = p.port_name""")
def _(fx):
    path = shared_dir(fx.spark, "wide_ports")
    wide = fx.harbours.select(
        F.col("port_id").alias("World Port Index (Number)"), F.col("port_name").alias("PORT_NAME"), F.col("country").alias("COUNTRY"),
        F.col("latitude").alias("LATITUDE"), F.col("longitude").alias("LONGITUDE"), F.lit(None).cast("string").alias("Remark, other"))
    files.write_csv(wide, path)
    ports = tables.import_ports(fx.spark, path, fx.harbour_bans)
    return ports.select("world_port_index_number", "port_name", "country", "latitude", "scrubber_status")
