"""Structured Streaming jobs over raw messages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidewake.operators.lookups import enrich_positions
from tidewake.operators.maintain import SHIP_FIRST, SHIP_LAST, correct_dimensions, first_dimensions
from tidewake.schemas import UNKNOWN_SHIPS
from tidewake.sources.messages import identified_statics, ingest
from tidewake.streaming.state import COUNTERS, Identities, Metrics, Ships, read_rows, read_state, use_state_store

DESTINATION_AGE_HOURS = 5
COMMIT_PERIOD = "10 seconds"
# Keys of the state: so many buckets of MMSIs, or of IMO numbers. A stream keeps its number for as long as its checkpoint.
BUCKETS = 1024

STATIC_COLUMNS = [
    "seq", "imo_number", "mmsi", "name", "ship_type", "length", "width", "max_draught", "destination",
    "timestamp_ais", "latitude", "longitude",
]


def _trigger(writer, once: bool):
    """All available data and stop, or a commit at least every ten seconds."""
    return writer.trigger(availableNow=True) if once else writer.trigger(processingTime=COMMIT_PERIOD)


def start_routing(raw: DataFrame, rings: DataFrame, path: str, checkpoint: str, keep_unknown: bool = False,
                  once: bool = True) -> StreamingQuery:
    """Ingest: parse, filter, route, and append every message to its route's folder.

    One stateless pass with the exactly-once file sink; routes are partitions of
    one table, so all kinds of rows of a micro-batch are committed together.
    """
    routed = ingest(raw, rings, keep_unknown)
    writer = routed.writeStream.format("parquet").partitionBy("route").option("path", path)
    return _trigger(writer.option("checkpointLocation", checkpoint).outputMode("append"), once).start()


def start_static_only(raw: DataFrame, rings: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Second stream over the same source that keeps only identified ship messages, also those without a legal time."""
    statics = identified_statics(ingest(raw, rings)).select(*STATIC_COLUMNS)
    writer = statics.writeStream.format("parquet").option("path", path)
    return _trigger(writer.option("checkpointLocation", checkpoint).outputMode("append"), once).start()


def _by_key(rows: DataFrame, column: str) -> DataFrame:
    """Add ``key``: the bucket of the column's value, or for rows without one a number below 0, so that these rows spread over the tasks."""
    bucket, spread = F.pmod(F.xxhash64(column), F.lit(BUCKETS)), -1 - F.pmod(F.xxhash64("seq"), F.lit(64))
    return rows.withColumn("key", F.when(F.col(column) >= 0, bucket).otherwise(spread))


def collected_rows(messages: DataFrame, keep_hours: int | None = None) -> DataFrame:
    """Rows of all tables of the collector, with ``table``, from routed messages.

    A position gets its identity from the newest ship message of its MMSI before
    it (by ``seq``) and its destination from the last ship message of its ship
    up to its own time. Both are state by bucket of numbers, so what a batch reads is
    its own rows and their buckets' state. Tables: ``positions``, ``static_log``, ``ships`` (each
    changed row of the master) and ``unknown_ships``: what has no identity, ship
    messages and positions alike.
    """
    use_state_store(messages.sparkSession)
    rows = messages.where(F.col("route").isin("static", "position", "unknown")).select("seq", "route", *UNKNOWN_SHIPS.fieldNames())
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields])
    named = _by_key(rows, "mmsi").groupBy("key").transformWithStateInPandas(Identities(schema), schema, "Append", "None")
    # The number that stands for an unknown identity is none.
    ship = F.when(F.col("route") != "unknown", F.col("imo_number"))
    keyed = _by_key(named.withColumn("_ship", ship), "_ship").drop("_ship")
    tables = T.StructType([*schema.fields, T.StructField("table", T.StringType())])
    return keyed.groupBy("key").transformWithStateInPandas(
        Ships(schema, DESTINATION_AGE_HOURS, keep_hours), tables, "Append", "ProcessingTime" if keep_hours else "None").drop("route")


def start_collector(raw: DataFrame, rings: DataFrame, path: str, checkpoint: str, once: bool = True,
                    keep_unknown: bool = False, keep_hours: int | None = None) -> StreamingQuery:
    """The whole collector: routing, ship master, identity and destination lookups.

    ``raw`` needs a ``seq`` column that orders the messages. All rows of a
    micro-batch are one write with ``table`` as a partition column, and one
    commit: readers see a batch in all tables or in none, and a
    restart repeats nothing (see ``collected``).
    """
    rows = collected_rows(ingest(raw, rings, keep_unknown), keep_hours)
    if not keep_unknown:
        rows = rows.where(F.col("table") != "unknown_ships")
    writer = rows.writeStream.format("parquet").partitionBy("table").option("path", path)
    return _trigger(writer.option("checkpointLocation", checkpoint).outputMode("append"), once).start()


def collected(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A table of the collector, as of its last commit."""
    return spark.read.parquet(path).where(F.col("table") == table).drop("table")


def current_ships(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The collector's ship master after its last batch, from its state: one row per ship, however long the stream has run."""
    # Operators are numbered from the sink's end of the plan.
    return read_rows(spark, checkpoint, 0, "ships").select("imo_number", *SHIP_FIRST, *SHIP_LAST)


def start_metrics(messages: DataFrame, checkpoint: str, ts: str = "ts", once: bool = True) -> StreamingQuery:
    """Minute metrics of routed messages, with identities as the collector finds them.

    The counters are state by vessel and minute; nothing is waited for, left out
    or written anywhere else.
    """
    use_state_store(messages.sparkSession)
    rows = messages.select("seq", "route", "mmsi", "imo_number", F.date_trunc("minute", ts).cast("timestamp_ntz").alias("arrived"))
    counted = _by_key(rows, "mmsi").groupBy("key").transformWithStateInPandas(Metrics(rows.schema), "key long", "Append", "None")
    return _trigger(counted.writeStream.format("noop").option("checkpointLocation", checkpoint), once).start()


def _vessel_minutes(spark: SparkSession, checkpoint: str) -> DataFrame:
    minute = F.expr("TIMESTAMP_NTZ '1970-01-01' + INTERVAL '1' MINUTE * minute")
    state = read_rows(spark, checkpoint, 0, "minutes").withColumns({"minute": minute, "identified": F.col("identified") > 0})
    return state.withColumn("vessel", F.when((F.col("mmsi") > 0) & (F.col("collected") > 0), F.col("mmsi")))


def _totals() -> list[Column]:
    return [
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTERS], F.count_distinct("vessel").alias("unique_vessels"),
        F.count_distinct(F.when(F.col("identified"), F.col("vessel"))).alias("vessels_with_imo"),
    ]


def _with_coverage(totals: DataFrame) -> DataFrame:
    return totals.withColumn("coverage", F.coalesce(F.try_divide("vessels_with_imo", "unique_vessels"), F.lit(0.0)))


def minute_metrics(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Per minute: the counters, distinct vessels, those with an identity, and their share."""
    return _with_coverage(_vessel_minutes(spark, checkpoint).groupBy("minute").agg(*_totals()))


def running_totals(spark: SparkSession, checkpoint: str) -> DataFrame:
    """One row: the counters, vessels and coverage over everything so far."""
    return _with_coverage(_vessel_minutes(spark, checkpoint).agg(*_totals()))


def start_enrichment(rows: DataFrame, lookup: DataFrame, path: str, checkpoint: str, once: bool = True,
                     enrich: Callable[[DataFrame, DataFrame], DataFrame] = enrich_positions) -> StreamingQuery:
    """Incremental enrichment of positions (status texts) or, with ``enrich_ships``, of ships (type texts).

    The checkpoint marks what is done, so every row is processed once, also where
    its text stays NULL.
    """
    writer = enrich(rows, lookup).writeStream.format("parquet").option("path", path)
    return _trigger(writer.option("checkpointLocation", checkpoint).outputMode("append"), once).start()


def start_dimension_fix(raw: DataFrame, rings: DataFrame, ships: DataFrame, checkpoint: str, once: bool = True) -> StreamingQuery:
    """One-time correction of length and width of the ``ships`` from the static-only stream.

    The first valid message of each ship is a streaming aggregate; its state is
    the table of corrections (see ``corrections``).
    """
    use_state_store(raw.sparkSession)
    known = ships.select("imo_number").distinct()
    statics = identified_statics(ingest(raw, rings)).select(*STATIC_COLUMNS).join(known, "imo_number", "left_semi")
    writer = first_dimensions(statics).writeStream.outputMode("update").format("noop")
    return _trigger(writer.option("checkpointLocation", checkpoint), once).start()


def corrections(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The first valid dimensions of each ship so far, as ship messages: one row a ship."""
    state = read_state(spark, checkpoint)
    first = state.columns[1]
    return state.select(
        "imo_number", F.col(first)["length"].alias("length"), F.col(first)["width"].alias("width"),
        F.col(first)["at"].alias("timestamp_ais"), F.col(first)["order"].alias("seq"))


def corrected_ships(ships: DataFrame, checkpoint: str) -> DataFrame:
    """``ships`` with all corrections made so far."""
    return correct_dimensions(ships, corrections(ships.sparkSession, checkpoint))
