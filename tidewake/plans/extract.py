"""Down-sampled analytic extract of positions with per-ship statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewake.functions.ais import in_range, operation_mode
from tidewake.operators.lookups import augment_emissions
from tidewake.operators.temporal import chunk_of, systematic_sample
from tidewake.schemas import EXTRACT_COLUMNS


def ship_stats(ships: DataFrame, positions: DataFrame, scrubbers: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Per ship: positions, mean speed, first and last report, distinct destinations, scrubber flag.

    Positions are aggregated before they meet the ship table. A ship that is on
    the scrubber list several times counts each position as often.
    """
    stats = positions.groupBy(*by, "imo_number").agg(
        F.count(F.lit(1)).alias("_n"), F.avg("sog").alias("avg_speed"),
        F.min("timestamp_collected").alias("first_seen"), F.max("timestamp_collected").alias("last_seen"),
        F.count_distinct("destination").alias("unique_destinations"),
    )
    listed = (
        scrubbers.groupBy(F.col("imo_number").cast("string").try_cast("bigint").alias("imo_number"))
        .agg(F.count(F.lit(1)).alias("_listed"))
    )
    joined = stats.join(ships.select("imo_number", "name", "ship_type"), "imo_number").join(listed, "imo_number", "left")
    return joined.select(
        *by, "imo_number", "name", "ship_type", F.col("_listed").isNotNull().alias("has_scrubber"),
        (F.col("_n") * F.coalesce("_listed", F.lit(1))).alias("position_count"),
        "avg_speed", "first_seen", "last_seen", "unique_destinations",
    )


def sampled_extract(
    ships: DataFrame, positions: DataFrame, scrubbers: DataFrame, start: str, end: str,
    chunk_days: int = 7, every: int = 1000, piece_rows: int | None = None,
) -> DataFrame:
    """Every ``every``-th position per ship and chunk within ``[start, end)``, with the chunk's ship statistics.

    All chunks are one plan. Positions are thinned out first, so only the kept
    rows meet the statistics.
    """
    in_time = positions.where(in_range(F.col("timestamp_collected"), start, end)).select(
        "id", "imo_number", "latitude", "longitude", "sog", "cog", "navigational_status_code",
        "timestamp_collected", "destination",
        chunk_of(F.col("timestamp_collected"), start, chunk_days).alias("chunk"),
    )
    stats = ship_stats(ships, in_time, scrubbers, by=("chunk",))
    kept = systematic_sample(in_time, ["chunk", "imo_number"], "timestamp_collected", every, "id", piece_rows)
    return kept.join(stats, ["chunk", "imo_number"]).select(*EXTRACT_COLUMNS)


def movement_extract(ships: DataFrame, positions: DataFrame, scrubbers: DataFrame) -> DataFrame:
    """The unsampled form of the extract over all positions, keeping ``id``."""
    stats = ship_stats(ships, positions, scrubbers)
    wanted = [c for c in EXTRACT_COLUMNS if c not in stats.columns]
    return positions.select("id", "imo_number", *wanted).join(stats, "imo_number").select(
        "id", *EXTRACT_COLUMNS
    )


def augmented_extract(extract: DataFrame, factors: DataFrame) -> DataFrame:
    """Add the operation mode and, for scrubber ships, the emission factors."""
    mode = operation_mode(F.col("navigational_status_code")).alias("operation_mode")
    return augment_emissions(extract.select("*", mode), factors, flag_is_per_ship=True)
