"""Joins with reference tables and between ship tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewake.functions.ais import is_blank, ne_null_true, parse_code
from tidewake.operators.temporal import asof_last


def lookup_with_default(
    df: DataFrame, key: Column, ref: DataFrame, ref_key: str, values: dict[str, object],
) -> DataFrame:
    """Left join to a reference table; ``values`` maps its columns to what stands for 'not found'."""
    side = ref.select(F.col(ref_key).alias("_ref_key"), *[F.col(v).alias(f"_ref_{v}") for v in values])
    joined = df.join(side, key == F.col("_ref_key"), "left")
    found = F.col("_ref_key").isNotNull()
    return joined.select(
        *[c for c in df.columns if c not in values],
        *[F.when(found, F.col(f"_ref_{v}")).otherwise(F.lit(d)).alias(v) for v, d in values.items()],
    )


def merge_with_suffix(left: DataFrame, right: DataFrame, on: str, suffix: str = "_wfr") -> DataFrame:
    """Inner join on a text key; right columns that also exist on the left get the suffix.

    Column order is key, left, right.
    """
    lcols, rcols = [c for c in left.columns if c != on], [c for c in right.columns if c != on]
    renamed = {c: f"{c}{suffix}" for c in rcols if c in lcols}
    left = left.withColumn(on, F.col(on).cast("string"))
    right = right.withColumn(on, F.col(on).cast("string")).withColumnsRenamed(renamed)
    return left.join(right, on).select(on, *lcols, *[renamed.get(c, c) for c in rcols])


def semi_filter(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key is in the list."""
    return df.join(keys.select(on), on, "left_semi")


def anti_filter(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key is not in the list; a missing key is not in it."""
    return df.join(keys.select(on), on, "left_anti")


def drop_prefix(df: DataFrame, prefix: str) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(prefix)])


EMISSIONS = ["emission_berth", "emission_anchor", "emission_maneuver", "emission_cruise"]


def augment_emissions(
    df: DataFrame, factors: DataFrame, key: str = "imo_number", flag_is_per_ship: bool = False,
) -> DataFrame:
    """Replace the ``emission_*`` columns by the factors of ships that appear with a scrubber.

    One flagged row is enough for a ship. Where ``has_scrubber`` is known to be
    the same on all rows of a ship, ``flag_is_per_ship`` saves the pass that
    looks for flagged ships.
    """
    wanted = factors.select(F.col(key).cast("bigint").alias(key), *EMISSIONS)
    bare = drop_prefix(df, "emission_")
    if flag_is_per_ship:
        joined = bare.join(wanted, key, "left")
        return joined.select(*bare.columns, *[F.when(F.col("has_scrubber"), F.col(c)).alias(c) for c in EMISSIONS])
    scrubber_ships = df.where("has_scrubber").select(key).distinct()
    wanted = wanted.join(scrubber_ships, key, "left_semi")
    return bare.join(wanted, key, "left").select(*bare.columns, *EMISSIONS)


def emission_coverage(df: DataFrame, key: str = "imo_number") -> DataFrame:
    covered = df.where(F.col("emission_berth").isNotNull())
    return covered.agg(F.count_distinct(key).alias("ships_with_emissions"))


def scrubber_split(ships: DataFrame, scrubbers: DataFrame, key: str = "imo_number", list_key: str = "imo_number",
                   status: str = "sox_scrubber_status") -> DataFrame:
    """Add ``scrubber_status`` from a list whose key may have another name and type."""
    side = scrubbers.select(
        F.col(list_key).cast("string").try_cast("bigint").alias("_list_key"), F.col(status).alias("_status")
    )
    joined = ships.join(side, F.col(key).cast("bigint") == F.col("_list_key"), "left")
    return joined.select(*ships.columns, F.coalesce("_status", F.lit("Non-Scrubber")).alias("scrubber_status"))


def scrubber_flag(ships: DataFrame, scrubbers: DataFrame, key: str = "imo_number") -> DataFrame:
    """Add ``has_scrubber``: the ship is on the list (whose key is text)."""
    listed = scrubbers.select(F.col(key).cast("string").try_cast("bigint").alias("_listed")).distinct()
    joined = ships.join(listed, F.col(key) == F.col("_listed"), "left")
    return joined.select(*ships.columns, F.col("_listed").isNotNull().alias("has_scrubber"))


def category_of_type(df: DataFrame, types: DataFrame) -> DataFrame:
    """Replace ``ship_type`` (a code as text) by the category of the code table."""
    codes = types.select(F.col("type_code").cast("string").alias("_code"), F.col("type").alias("_type"))
    joined = df.join(codes, F.col("ship_type") == F.col("_code"), "left")
    return joined.select(*[F.col("_type").alias(c) if c == "ship_type" else c for c in df.columns])


def enrich_ships(ships: DataFrame, types: DataFrame) -> DataFrame:
    """Add or complete ``type_name`` and ``type_remark`` of ships that still miss one of them.

    ``ship_type`` becomes the parsed code where one is found.
    """
    for column in ("type_name", "type_remark"):
        if column not in ships.columns:
            ships = ships.withColumn(column, F.lit(None).cast("string"))
    codes = types.select(F.col("type_code").alias("_code"), F.col("type").alias("_type"), F.col("remark").alias("_remark"))
    parsed = ships.withColumn("_parsed", parse_code(F.col("ship_type")))
    joined = parsed.join(codes, F.col("_parsed") == F.col("_code"), "left")
    pending = F.col("type_name").isNull() | F.col("type_remark").isNull()
    name = F.when(F.col("_code").isNotNull(), F.col("_type")).otherwise("Unknown")
    remark = (
        F.when(is_blank(F.col("ship_type")), "No ship type provided")
        .when(F.col("_parsed").isNull(), "Invalid ship type")
        .when(F.col("_code").isNotNull(), F.col("_remark"))
        .otherwise("Unknown")
    )
    new = {
        "ship_type": F.coalesce(F.col("_parsed").cast("string"), F.col("ship_type")),
        "type_name": name, "type_remark": remark,
    }
    return joined.select(*[
        F.when(pending, new[c]).otherwise(F.col(c)).alias(c) if c in new else c for c in ships.columns
    ])


def enrich_positions(positions: DataFrame, statuses: DataFrame) -> DataFrame:
    """Add or complete ``navigational_status``; missing, bad and unlisted codes are 'Unknown'."""
    if "navigational_status" not in positions.columns:
        positions = positions.withColumn("navigational_status", F.lit(None).cast("string"))
    side = statuses.select(
        F.col("navigational_status_code").alias("_code"), F.col("navigational_status").alias("_status")
    )
    code = F.col("navigational_status_code")
    if isinstance(positions.schema["navigational_status_code"].dataType, T.StringType):
        code = parse_code(code)
    joined = positions.join(side, code == F.col("_code"), "left")
    status = F.coalesce("navigational_status", F.when(F.col("_code").isNotNull(), F.col("_status")).otherwise("Unknown"))
    return joined.select(*[status.alias(c) if c == "navigational_status" else c for c in positions.columns])


def resolve_identity(positions: DataFrame, statics: DataFrame, stored: DataFrame, seq: str = "seq",
                     **kwargs) -> DataFrame:
    """Add ``imo_number`` to positions that carry only an MMSI.

    The newest identity message before the position counts; else any stored
    ship with that MMSI (the lowest IMO number, to be repeatable).
    """
    valid = statics.where((F.col("imo_number") != 0) & F.col("mmsi").isNotNull())
    known = stored.where(F.col("mmsi").isNotNull()).groupBy(F.col("mmsi").alias("_mmsi")).agg(
        F.min("imo_number").alias("_stored_imo")
    )
    found = asof_last(positions, valid, "mmsi", seq, seq, ["imo_number"], include_equal=False, **kwargs)
    joined = found.join(known, F.col("mmsi") == F.col("_mmsi"), "left")
    return joined.select(*positions.columns, F.coalesce("asof_imo_number", "_stored_imo").alias("imo_number"))


def exclude_rows(df: DataFrame, unwanted: dict[str, object]) -> DataFrame:
    """Drop rows where any listed column has the unwanted value; NULL never has it."""
    for column, value in unwanted.items():
        df = df.where(ne_null_true(F.col(column), value))
    return df
