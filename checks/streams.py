"""Streaming jobs (run to the end of the given events) and the forecast."""

from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from checks.fixtures import SQL, Fixtures
from checks.registry import query, rounded
from checks.rows import region
from checks.tables import OLD_SHIPS, uncorrected_ships
from checks.views import given, ts
from tidewake.operators import temporal
from tidewake.plans import forecast as fc
from tidewake.session import shared_dir
from tidewake.sources.messages import ingest, read_messages
from tidewake.streaming import ingest as jobs


def streaming(fx: Fixtures) -> Fixtures:
    """The same fixtures over ``events`` as a stream."""
    folder, _, file = fx.events.inputFiles()[0].rpartition("/")
    reader = fx.spark.readStream.schema(fx.events.schema).option("pathGlobFilter", file)
    return Fixtures(fx.spark, "", reader.parquet(folder))


def raw_messages(fx: Fixtures, with_time: bool = False):
    """Message stream with its sequence number (and the time of the event)."""
    text = SQL["fx_messages"].replace("{", "{{").replace("}", "}}").replace("FROM events", "FROM {events}")
    text = text.replace("SELECT event_id,", "SELECT event_id AS seq, ts," if with_time else "SELECT event_id AS seq,")
    return fx.spark.sql(text, events=streaming(fx).events)


def finish(started: StreamingQuery) -> None:
    started.awaitTermination()
    if started.exception():
        raise started.exception()


@query("stream_ingest", given("routed") + """
SELECT seq, route, mmsi, CASE WHEN message_type IS DISTINCT FROM 'ShipStaticData' THEN NULL WHEN raw_imo IS NULL THEN -1 ELSE raw_imo END AS imo_number
FROM routed""")
def _(fx):
    path = shared_dir(fx.spark, "routed")
    finish(jobs.start_routing(raw_messages(fx), region(fx), path, path + "-checkpoint"))
    return fx.spark.read.parquet(path).select("seq", "route", "mmsi", "imo_number")


@query("stream_quarantine", given("routed") + "SELECT seq, raw, reject FROM routed WHERE route = 'quarantine'")
def _(fx):
    path = shared_dir(fx.spark, "routed")
    finish(jobs.start_routing(raw_messages(fx), region(fx), path, path + "-checkpoint"))
    return fx.spark.read.parquet(path).where("route = 'quarantine'").select("seq", "raw", "reject")


@query("stream_static_only", given("corrections") + f"""
SELECT seq, imo_number, mmsi, name, length, width, {ts('timestamp_ais')} AS timestamp_ais FROM corrections""")
def _(fx):
    path = shared_dir(fx.spark, "statics")
    finish(jobs.start_static_only(raw_messages(fx), region(fx), path, path + "-checkpoint"))
    return fx.spark.read.parquet(path).select("seq", "imo_number", "mmsi", "name", "length", "width", "timestamp_ais")


@query("stream_text_routes", given("routed") + "SELECT route, count(*) AS n FROM routed GROUP BY route")
def _(fx):
    """Messages landed as text files, one per line."""
    path = shared_dir(fx.spark, "landed")
    fx.messages.select("raw").write.text(path)
    finish(jobs.start_routing(read_messages(fx.spark, path, max_files=2), region(fx), path + "-routed", path + "-checkpoint"))
    return fx.spark.read.parquet(path + "-routed").groupBy("route").agg(F.count(F.lit(1)).alias("n"))


def collected(fx, keep_unknown=False) -> str:
    path = shared_dir(fx.spark, "collector")
    finish(jobs.start_collector(raw_messages(fx), region(fx), path, path + "-checkpoint", keep_unknown=keep_unknown))
    return path


@query("stream_upsert_ships", given("master") + "SELECT * FROM master")
def _(fx):
    return jobs.current_ships(fx.spark, collected(fx) + "-checkpoint")


@query("stream_positions", given("unstored", "statics") + """
SELECT p.seq, p.mmsi, p.imo_number, (SELECT arg_max(s.destination, (s.timestamp_ais, s.seq)) FROM statics s WHERE s.imo_number = p.imo_number
 AND s.timestamp_ais <= p.timestamp_ais AND s.timestamp_ais > p.timestamp_ais - INTERVAL 5 HOUR) AS destination
FROM unstored p WHERE p.imo_number IS NOT NULL""")
def _(fx):
    return jobs.collected(fx.spark, collected(fx), "positions").select("seq", "mmsi", "imo_number", "destination")


@query("stream_unknown_positions", given("unstored") + "SELECT seq, mmsi, CAST(-1 AS BIGINT) AS imo_number FROM unstored WHERE imo_number IS NULL")
def _(fx):
    unknown = jobs.collected(fx.spark, collected(fx, keep_unknown=True), "unknown_ships")
    return unknown.where("sog IS NOT NULL").select("seq", "mmsi", "imo_number")


@query("stream_unknown_ships", given("unstored", "routed") + """
SELECT seq, mmsi, CAST(-1 AS BIGINT) AS imo_number, CAST(NULL AS VARCHAR) AS name FROM unstored WHERE imo_number IS NULL
UNION ALL SELECT seq, mmsi, coalesce(raw_imo, -1), coalesce(name, 'Unknown') FROM routed WHERE route = 'no_imo'""")
def _(fx):
    unknown = jobs.collected(fx.spark, collected(fx, keep_unknown=True), "unknown_ships")
    return unknown.select("seq", "mmsi", "imo_number", "name")


def in_batches(fx, raw, n, start):
    """Land the messages in ``n`` parts, oldest first, and after each let the stream take what is new and stop."""
    path, last = shared_dir(fx.spark, "landed"), raw.agg(F.max("seq")).first()[0]
    for i in range(n):
        raw.where((F.col("seq") * n >= i * (last + 1)) & (F.col("seq") * n < (i + 1) * (last + 1))).write.mode("append").parquet(path)
        finish(start(fx.spark.readStream.schema(raw.schema).parquet(path)))


@query("stream_identity_batches", given("routed", "statics") + """
, changed AS (SELECT seq, route, raw_imo, mmsi + CASE WHEN seq % 8 >= 4 THEN 100000000 ELSE 0 END AS mmsi FROM routed)
SELECT p.seq, p.mmsi, (SELECT arg_max(s.raw_imo, s.seq) FROM changed s WHERE s.route = 'static' AND s.mmsi = p.mmsi AND s.seq < p.seq) AS imo_number
FROM changed p WHERE p.route = 'position'""")
def _(fx):
    """Ships change their MMSI back and forth; the newest identity of an MMSI holds over micro-batches and restarts."""
    text = F.when(F.col("event_id") % 8 >= 4, F.replace("raw", F.lit('"MMSI":2'), F.lit('"MMSI":3'))).otherwise(F.col("raw"))
    raw = fx.messages.select(F.col("event_id").alias("seq"), text.alias("raw"))
    path = shared_dir(fx.spark, "collector")
    in_batches(fx, raw, 3, lambda stream: jobs.start_collector(stream, region(fx), path, path + "-checkpoint", keep_unknown=True))
    found = jobs.collected(fx.spark, path, "positions").select("seq", "mmsi", "imo_number")
    lost = jobs.collected(fx.spark, path, "unknown_ships").where("sog IS NOT NULL")
    return found.unionByName(lost.select("seq", "mmsi", F.lit(None).cast("bigint").alias("imo_number")))


METRICS = given("routed", "unstored") + """
, timed AS (SELECT r.route, r.mmsi, e.ts, CASE r.route WHEN 'position' THEN u.imo_number WHEN 'static' THEN r.raw_imo END AS imo,
  r.route IN ('static', 'position', 'no_imo') AS used FROM routed r JOIN events e ON e.event_id = r.seq LEFT JOIN unstored u ON u.seq = r.seq)
"""
COUNTS = """
 count(*) FILTER (WHERE used) AS collected, count(*) FILTER (WHERE route = 'outside') AS filtered, count(*) FILTER (WHERE route = 'static') AS static_data,
 count(*) FILTER (WHERE route = 'position' AND imo > 0) AS position_data, count(*) FILTER (WHERE used AND coalesce(imo, 0) <= 0) AS no_imo,
 count(DISTINCT mmsi) FILTER (WHERE used) AS unique_vessels, count(DISTINCT mmsi) FILTER (WHERE used AND imo > 0) AS vessels_with_imo,
 round(coalesce(count(DISTINCT mmsi) FILTER (WHERE used AND imo > 0) * 1e0 / nullif(count(DISTINCT mmsi) FILTER (WHERE used), 0), 0), 6) AS coverage
"""


def measured(fx) -> str:
    checkpoint = shared_dir(fx.spark, "metrics")
    routed = ingest(raw_messages(fx, with_time=True), region(fx))
    finish(jobs.start_metrics(routed, checkpoint))
    return checkpoint


@query("stream_minute_metrics", METRICS + f"""
SELECT strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S.%f') AS minute, {COUNTS} FROM timed GROUP BY date_trunc('minute', ts)""")
def _(fx):
    return rounded(jobs.minute_metrics(fx.spark, measured(fx)), coverage=6)


@query("stream_running_totals", METRICS + f"SELECT {COUNTS} FROM timed")
def _(fx):
    return rounded(jobs.running_totals(fx.spark, measured(fx)), coverage=6)


@query("stream_enrich", given("fx_positions", "fx_nav_status") + """
SELECT p.id, coalesce(s.navigational_status, 'Unknown') AS navigational_status FROM fx_positions p
LEFT JOIN fx_nav_status s ON s.navigational_status_code = p.navigational_status_code""")
def _(fx):
    path = shared_dir(fx.spark, "enriched")
    finish(jobs.start_enrichment(streaming(fx).positions, fx.nav_status, path, path + "-checkpoint"))
    return fx.spark.read.parquet(path).select("id", "navigational_status")


@query("stream_dimension_fix", given("fixes", "fx_ships") + f"""
SELECT s.imo_number, CASE WHEN f.imo_number IS NOT NULL AND NOT s.done THEN f.length ELSE s.length END AS length,
 CASE WHEN f.imo_number IS NOT NULL AND NOT s.done THEN f.width ELSE s.width END AS width, s.done OR f.imo_number IS NOT NULL AS lw_correction
FROM {OLD_SHIPS} s LEFT JOIN fixes f ON f.imo_number = s.imo_number""")
def _(fx):
    checkpoint = shared_dir(fx.spark, "dimensions")
    finish(jobs.start_dimension_fix(raw_messages(fx), region(fx), uncorrected_ships(fx), checkpoint))
    return jobs.corrected_ships(uncorrected_ships(fx), checkpoint).select("imo_number", "length", "width", "lw_correction")


# ------------------------------------------------------------------- forecast

LAGGED = given("fx_daily") + """
, lagged AS (SELECT CAST(date AS VARCHAR) AS date, country, pollution, CAST(isodow(date) - 1 AS INTEGER) AS day_of_week, CAST(month(date) AS INTEGER) AS month,
 CAST(day(date) AS INTEGER) AS day, lag(pollution, 1) OVER w AS lag_1, lag(pollution, 7) OVER w AS lag_7, lag(pollution, 14) OVER w AS lag_14
 FROM fx_daily WHERE country <> 'error' WINDOW w AS (PARTITION BY country ORDER BY date))
"""


@query("lag_features", LAGGED + "SELECT * FROM lagged WHERE lag_14 IS NOT NULL")
def _(fx):
    return fc.forecast_features(fx.daily, exclude="error")


@query("trailing_14", given("fx_daily") + """
SELECT country, CAST(pos AS INTEGER) AS pos, value FROM (SELECT country, row_number() OVER (PARTITION BY country ORDER BY date)
 - count(*) OVER (PARTITION BY country) + 13 AS pos, pollution AS value FROM fx_daily) WHERE pos >= 0""")
def _(fx):
    return temporal.trailing_values(fx.daily, "country", "date", "pollution").select("country", F.posexplode("trailing").alias("pos", "value"))


@query("future_calendar", given("fx_daily") + """
SELECT country, CAST(step AS INTEGER) AS step, CAST(d AS VARCHAR) AS date, CAST(isodow(d) - 1 AS INTEGER) AS day_of_week,
 CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day
FROM (SELECT country, step, CAST(last + CAST(step AS INTEGER) AS DATE) AS d FROM (SELECT country, max(date) AS last FROM fx_daily GROUP BY country), range(31) r(step))""")
def _(fx):
    return temporal.future_calendar(fx.daily, "country", "date")


# The forecast's bookkeeping on a plain model (value of a week ago, lags as ensemble).

BANDS = LAGGED + """
, ahead AS (SELECT country, date, lag_7 AS prediction, sqrt(((lag_1 - m) ** 2 + (lag_7 - m) ** 2 + (lag_14 - m) ** 2) / 3) AS std
 FROM (SELECT *, (lag_1 + lag_7 + lag_14) / 3 AS m FROM lagged WHERE lag_14 IS NOT NULL))
"""


def week_ago(fx):
    features = fc.forecast_features(fx.daily, exclude="error")
    members = features.unpivot(["country", "date"], ["lag_1", "lag_7", "lag_14"], "member", "prediction")
    return features, fc.with_band(features.select("country", "date", F.col("lag_7").alias("prediction")), members)


@query("ensemble_band", BANDS + """
SELECT country, date, round(prediction, 4) AS prediction, round(std, 4) AS std, round(prediction - 1.96e0 * std, 4) AS lower,
 round(prediction + 1.96e0 * std, 4) AS upper FROM ahead""")
def _(fx):
    return rounded(week_ago(fx)[1], prediction=4, std=4, lower=4, upper=4)


@query("ensemble_with_last_actual", BANDS + """
SELECT country, date, round(prediction, 4) AS prediction, round(std, 4) AS std, 'forecast' AS kind FROM ahead
UNION ALL SELECT country, CAST(max(date) AS VARCHAR), round(arg_max(pollution, date), 4), 0, 'actual' FROM fx_daily WHERE country <> 'error' GROUP BY country""")
def _(fx):
    extended = fc.with_last_actual(week_ago(fx)[1], fx.daily)
    return rounded(extended.select("country", "date", "prediction", "std", "kind"), prediction=4, std=4)


@query("ensemble_scale", BANDS + """
, seen AS (SELECT country, max(pollution) AS hi, min(pollution) AS lo FROM lagged WHERE lag_14 IS NOT NULL GROUP BY country),
band AS (SELECT country, max(prediction) + 1.96e0 * max(std) AS hi, min(prediction) - 1.96e0 * min(std) AS lo FROM ahead GROUP BY country)
SELECT round(greatest(0, max(greatest(s.hi, b.hi))), 4) AS max_pollution, round(min(least(s.lo, b.lo)), 4) AS min_pollution
FROM seen s JOIN band b ON b.country = s.country""")
def _(fx):
    return rounded(fc.common_scale(*week_ago(fx)), max_pollution=4, min_pollution=4)


@query("backtest_errors", LAGGED + """
SELECT country, round(avg(abs(lag_7 - pollution)), 4) AS mae, round(sqrt(avg((lag_7 - pollution) ** 2)), 4) AS rmse, count(*) AS days
FROM lagged WHERE lag_14 IS NOT NULL GROUP BY country""")
def _(fx):
    return rounded(fc.backtest_by_series(week_ago(fx)[0].withColumn("fitted", F.col("lag_7"))), mae=4, rmse=4)


# Without bootstrap every tree of a forest is the one regression tree that SQL can grow too: at each node the first cut with the
# largest decrease of variance, over all features and all midpoints between neighbouring values.

DEPTH = 2
TREES = 3


def regression_tree() -> str:
    """CTEs ``long`` (values by feature), ``split`` (feature and cut of each node) and ``leaf`` (mean of each node), ``at_n`` (node of each row at depth n)."""
    long = " UNION ALL ".join(f"SELECT country, date, pollution AS p, {k} AS f, CAST({c} AS DOUBLE) AS v FROM used" for k, c in enumerate(fc.FEATURES))
    text = f"""
, used AS (SELECT * FROM lagged WHERE lag_14 IS NOT NULL)
, long AS ({long})
, at_0 AS (SELECT country, date, 1 AS node FROM used)"""
    for d in range(DEPTH):
        text += f"""
, sums_{d} AS (SELECT country, node, f, v, count(*) AS n, sum(p) AS s, sum(p * p) AS q FROM long JOIN at_{d} USING (country, date) GROUP BY country, node, f, v)
, cuts_{d} AS (SELECT *, sum(n) OVER w AS ln, sum(s) OVER w AS ls, sum(n) OVER t AS tn, sum(s) OVER t AS ts, lead(v) OVER w AS nv FROM sums_{d}
 WINDOW w AS (PARTITION BY country, node, f ORDER BY v), t AS (PARTITION BY country, node, f))
, split_{d} AS (SELECT country, node, f, (v + nv) / 2 AS cut FROM (
 SELECT *, (ls * ls / ln + (ts - ls) * (ts - ls) / (tn - ln) - ts * ts / tn) / tn AS gain FROM cuts_{d} WHERE nv IS NOT NULL) WHERE gain > 1e-9
 QUALIFY row_number() OVER (PARTITION BY country, node ORDER BY round(gain, 6) DESC, f, v) = 1)
, at_{d + 1} AS (SELECT a.country, a.date, CASE WHEN s.f IS NULL THEN a.node WHEN l.v <= s.cut THEN 2 * a.node ELSE 2 * a.node + 1 END AS node
 FROM at_{d} a LEFT JOIN split_{d} s ON s.country = a.country AND s.node = a.node LEFT JOIN long l ON l.country = a.country AND l.date = a.date AND l.f = s.f)"""
    return text + f"""
, split AS ({" UNION ALL ".join(f"SELECT * FROM split_{d}" for d in range(DEPTH))})
, leaf AS (SELECT country, node, avg(pollution) AS value FROM at_{DEPTH} JOIN used USING (country, date) GROUP BY country, node)
, fit AS (SELECT country, date, pollution, value AS fitted FROM at_{DEPTH} JOIN used USING (country, date) JOIN leaf USING (country, node))
"""


def recursive_forecast() -> str:
    """CTE ``ahead``: 31 days from the last one on, each fed by the predictions before it."""
    def value(split: str) -> str:
        lags = " ".join(f"WHEN {3 + k} THEN r.line[{15 - lag} + r.step]" for k, lag in enumerate(fc.LAGS))
        return f"CASE {split}.f WHEN 0 THEN isodow(r.day) - 1 WHEN 1 THEN month(r.day) WHEN 2 THEN day(r.day) {lags} END"

    first = f"CASE WHEN {value('a')} <= a.cut THEN 2 ELSE 3 END"
    return f"""
, newest AS (SELECT country, max(date) AS last, list(pollution ORDER BY date)[-14:] AS line FROM whole WHERE country <> 'error' GROUP BY country)
, run AS (
 SELECT country, 0 AS step, CAST(last AS DATE) AS day, line FROM newest
 UNION ALL
 SELECT r.country, r.step + 1, CAST(r.day + 1 AS DATE), list_append(r.line, l.value) FROM run r
 LEFT JOIN split a ON a.country = r.country AND a.node = 1
 LEFT JOIN split b ON b.country = r.country AND b.node = {first}
 JOIN leaf l ON l.country = r.country AND l.node = CASE WHEN a.f IS NULL THEN 1 WHEN b.f IS NULL THEN {first}
  WHEN {value('b')} <= b.cut THEN 2 * {first} ELSE 2 * {first} + 1 END
 WHERE r.step < {fc.HORIZON}
)
, ahead AS (SELECT country, CAST(CAST(day - 1 AS DATE) AS VARCHAR) AS date, line[14 + step] AS prediction FROM run WHERE step > 0)
"""


# Whole numbers: their sums are exact, so cuts that part the rows alike have equal gains in both engines and the first one counts.
WHOLE = ", whole AS (SELECT date, country, round(pollution) AS pollution FROM fx_daily)\n, lagged AS"
FOREST = LAGGED.replace("WITH ", "WITH RECURSIVE ", 1).replace(", lagged AS", WHOLE).replace("FROM fx_daily WHERE", "FROM whole WHERE") + regression_tree()


def whole(fx):
    return fx.daily.withColumn("pollution", F.round("pollution"))


def forests(fx):
    """The forests SQL can grow: trees of two levels on all rows."""
    return fc.forecast_job(whole(fx), exclude="error", trees=TREES, max_depth=DEPTH, bootstrap=False)


@query("forecast_fit", FOREST + "SELECT country, date, pollution, round(fitted, 4) AS fitted FROM fit")
def _(fx):
    return rounded(forests(fx).fitted(), fitted=4)


@query("forecast_band", FOREST + recursive_forecast() + """
SELECT country, date, 'forecast' AS kind, round(prediction, 4) AS prediction, 0e0 AS std, round(prediction, 4) AS lower, round(prediction, 4) AS upper FROM ahead
UNION ALL SELECT country, CAST(last AS VARCHAR), 'actual', round(line[14], 4), 0e0, round(line[14], 4), round(line[14], 4) FROM newest""")
def _(fx):
    job = forests(fx)
    extended = fc.with_last_actual(job.ahead(), whole(fx))
    return rounded(extended, prediction=4, std=4, lower=4, upper=4).select("country", "date", "kind", "prediction", "std", "lower", "upper")


@query("forecast_scale", FOREST + recursive_forecast() + """
, seen AS (SELECT max(pollution) AS hi, min(pollution) AS lo FROM used), next AS (SELECT max(prediction) AS hi, min(prediction) AS lo FROM ahead)
SELECT round(greatest(0, s.hi, n.hi), 4) AS max_pollution, round(least(s.lo, n.lo), 4) AS min_pollution FROM seen s, next n""")
def _(fx):
    job = forests(fx)
    return rounded(fc.common_scale(job.features, job.ahead()), max_pollution=4, min_pollution=4)


@query("forecast_backtest", FOREST + """
SELECT country, round(avg(abs(fitted - pollution)), 4) AS mae, round(sqrt(avg((fitted - pollution) ** 2)), 4) AS rmse, count(*) AS days FROM fit GROUP BY country""")
def _(fx):
    return rounded(fc.backtest_by_series(forests(fx).fitted()), mae=4, rmse=4)


@query("forecast_forest")
def _(fx):
    """The forest as users fit it, on random samples; the tests hold it to its own trees."""
    job = fc.forecast_job(fx.daily)
    return fc.with_last_actual(job.ahead(), fx.daily)
