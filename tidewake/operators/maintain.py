"""Ship master maintenance as DataFrame jobs over append-only logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewake.functions.ais import ne_null_true


def upsert_latest(log: DataFrame, key: str, first: tuple[str, ...], last: tuple[str, ...], order: str) -> DataFrame:
    """One row per key: ``first`` columns from its first log row, ``last`` columns from its last.

    Later NULLs overwrite. A plain aggregate: any number of messages of one ship
    is reduced before the shuffle.
    """
    oldest = F.min_by(F.struct(*first), order).alias("_first")
    newest = F.max_by(F.struct(*last), order).alias("_last")
    return log.groupBy(key).agg(oldest, newest).select(
        key, *[F.col("_first")[c].alias(c) for c in first], *[F.col("_last")[c].alias(c) for c in last]
    )


SHIP_FIRST = ("mmsi",)
SHIP_LAST = ("name", "ship_type", "length", "width", "max_draught")


def upsert_ships(statics: DataFrame, existing: DataFrame | None = None, order: str = "seq") -> DataFrame:
    """Ship master from ship messages, on top of an existing master whose rows come first."""
    columns = ["imo_number", *SHIP_FIRST, *SHIP_LAST, order]
    log = statics.select(*columns)
    if existing is not None:
        lowest = F.lit(-(2 ** 62)).cast(statics.schema[order].dataType)
        log = existing.withColumn(order, lowest).select(*columns).unionByName(log)
    return upsert_latest(log, "imo_number", SHIP_FIRST, SHIP_LAST, order)


def first_dimensions(statics: DataFrame, order: str = "seq") -> DataFrame:
    """First message per ship that gives a length or a width."""
    valid = statics.where(F.col("length").isNotNull() | F.col("width").isNotNull())
    return valid.groupBy("imo_number").agg(
        F.min_by(F.struct("length", "width", F.col("timestamp_ais").alias("at"), F.col(order).alias("order")), order)
        .alias("_fix")
    )


def correct_dimensions(ships: DataFrame, statics: DataFrame, order: str = "seq") -> DataFrame:
    """Set length and width of ships not yet corrected, once, and mark them.

    Both dimensions are taken from the first valid message, even if one of them
    is NULL there. Messages of unknown ships have no effect.
    """
    if "lw_correction" not in ships.columns:
        ships = ships.withColumns({
            "lw_correction": F.lit(False), "lw_correction_timestamp": F.lit(None).cast("timestamp_ntz")
        })
    fixes = first_dimensions(statics, order).withColumnRenamed("imo_number", "_imo")
    joined = ships.join(fixes, F.col("imo_number") == F.col("_imo"), "left")
    fix = F.col("_fix").isNotNull() & ne_null_true(F.col("lw_correction"), True)
    new = {
        "length": F.col("_fix.length"), "width": F.col("_fix.width"), "lw_correction": F.lit(True),
        "lw_correction_timestamp": F.col("_fix.at"),
    }
    return joined.select(*[
        F.when(fix, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in ships.columns
    ])


def correction_counters(ships: DataFrame, statics: DataFrame, order: str = "seq") -> DataFrame:
    """One row: ship messages processed, corrections made, and messages ignored.

    Ignored are messages of unknown ships and of ships corrected before; valid
    messages that carry no dimensions for an uncorrected ship are neither.
    """
    corrected_before = ships.select(
        F.col("imo_number").alias("_imo"), F.coalesce(F.col("lw_correction"), F.lit(False)).alias("_done")
        if "lw_correction" in ships.columns else F.lit(False).alias("_done"),
    )
    first = first_dimensions(statics, order).select(F.col("imo_number").alias("_fix_imo"), F.col("_fix.order").alias("_at"))
    per_ship = corrected_before.join(first, F.col("_imo") == F.col("_fix_imo"), "left").select("_imo", "_done", "_at")
    joined = statics.join(per_ship, F.col("imo_number") == F.col("_imo"), "left")
    known, open_ship = F.col("_imo").isNotNull(), F.col("_imo").isNotNull() & ~F.col("_done")
    return joined.agg(
        F.count(F.lit(1)).alias("processed"),
        F.count_if(open_ship & (F.col(order) == F.col("_at"))).alias("corrected"),
        F.count_if(~known | F.col("_done") | (F.col(order) > F.col("_at"))).alias("ignored"),
    )


def coverage_metrics(messages: DataFrame) -> DataFrame:
    """Collection counters over routed messages with resolved ``imo_number`` (NULL if unresolved).

    Counted per vessel and then over the vessels, in one pass.
    """
    used = F.col("route").isin("static", "position", "no_imo", "unknown")
    identified = F.coalesce(F.col("imo_number") > 0, F.lit(False))
    counters = {
        "collected": used,
        "filtered": F.col("route") == "outside",
        "static_data": F.col("route") == "static",
        "position_data": (F.col("route") == "position") & identified,
        "no_imo": used & ~identified,
    }
    per_vessel = messages.groupBy("mmsi").agg(
        *[F.count_if(hit).alias(name) for name, hit in counters.items()],
        F.coalesce(F.bool_or(used & identified), F.lit(False)).alias("_identified"),
    )
    vessel = (F.col("mmsi") != 0) & (F.col("collected") > 0)
    totals = per_vessel.agg(
        F.count_if(vessel).alias("unique_vessels"), F.count_if(vessel & F.col("_identified")).alias("vessels_with_imo"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in counters],
    )
    ratio = F.coalesce(F.try_divide("vessels_with_imo", "unique_vessels"), F.lit(0.0))
    return totals.select(*counters, "unique_vessels", "vessels_with_imo", ratio.alias("coverage"))
