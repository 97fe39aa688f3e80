"""Normalised destinations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewake.functions.destinations import (
    CORRECTIONS, PORT_CODES, PROFILE_CODES, PROFILE_CORRECTIONS, apply_rules, clean_destination, map_codes,
    split_destination,
)


def normalize_destinations(
    df: DataFrame, codes: Mapping[str, str] = PORT_CODES, rules: Sequence[tuple[str, str]] = tuple(CORRECTIONS),
    column: str = "destination", lookup: bool = True,
) -> DataFrame:
    """Clean, map and correct ``column``, and add ``secondary_destination``; empty becomes NULL.

    Reports repeat the same texts, so the distinct ones are worked on and joined
    back; adaptive execution broadcasts a short list and splits hot texts
    otherwise. Streams, and rows with ``lookup=False``, are worked on where they are.
    """
    fixed = apply_rules(map_codes(clean_destination(F.col(column)), codes), rules)
    split = split_destination(fixed, codes).alias("_ports")
    if lookup and not df.isStreaming:
        texts = df.select(column).where(F.col(column).isNotNull()).distinct()
        table = texts.select(F.col(column).alias("_text"), split)
        ports = df.join(table, F.col(column) == F.col("_text"), "left")
    else:
        ports = df.select("*", split)
    kept = [F.nullif(F.col("_ports.primary"), F.lit("")).alias(c) if c == column else c for c in df.columns]
    return ports.select(*kept, F.col("_ports.secondary").alias("secondary_destination"))


def profile_destinations(df: DataFrame, column: str = "destination") -> DataFrame:
    """The exploratory variant: shorter lists, no splitting."""
    fixed = apply_rules(map_codes(clean_destination(F.col(column)), PROFILE_CODES), PROFILE_CORRECTIONS)
    return df.withColumn(column, F.nullif(fixed, F.lit("")))
