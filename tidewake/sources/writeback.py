"""Deletes that write back to partitioned catalog tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewake.operators.regions import within_region
from tidewake.operators.temporal import dedup_reports
from tidewake.session import materialize


def _replace_partitions(rows: DataFrame, table: str) -> None:
    """Overwrite the partitions that the rows are of, and no others."""
    conf, key = rows.sparkSession.conf, "spark.sql.sources.partitionOverwriteMode"
    before = conf.get(key)
    conf.set(key, "dynamic")
    try:
        rows.write.mode("overwrite").insertInto(table)
    finally:
        conf.set(key, before)


def rewrite_partitions(
    spark: SparkSession, table: str, partition: str, kept: Callable[[DataFrame], DataFrame], dry_run: bool = False, at_a_time: int = 50,
) -> DataFrame:
    """Delete from ``table`` what ``kept`` leaves out; returns the audit: rows in all, kept and deleted per partition.

    ``kept`` maps rows of whole partitions to those of them that stay. Only
    partitions with something to delete are written, some at a time, and an
    emptied one is dropped; the others keep their files. A run that breaks off
    leaves whole partitions, and repeating it does the rest. ``dry_run`` only audits.
    Of a table with a path of its own Spark leaves the files of dropped partitions in place; the table no longer reads them.
    """
    rows = spark.read.table(table)
    counts = rows.groupBy(partition).agg(F.count(F.lit(1)).alias("total"))
    left = kept(rows).groupBy(F.col(partition).alias("_value")).agg(F.count(F.lit(1)).alias("_kept"))
    audit = counts.join(left, F.col(partition).eqNullSafe(F.col("_value")), "left").select(
        partition, "total", F.coalesce("_kept", F.lit(0)).alias("kept"), (F.col("total") - F.coalesce("_kept", F.lit(0))).alias("deleted"))
    audit = materialize(audit, "audit")
    if dry_run:
        return audit
    # One row per partition of the table.
    hit = [(r[partition], r["kept"]) for r in audit.where("deleted > 0").orderBy(partition).collect()]
    for start in range(0, len(hit), at_a_time):
        lot = hit[start:start + at_a_time]
        named = F.col(partition).isin([v for v, _ in lot if v is not None])
        if any(v is None for v, _ in lot):
            named = named | F.col(partition).isNull()
        # Stored first, since the table can't be read while its partitions are replaced.
        stay = materialize(kept(rows.where(named)).select(*rows.columns), "kept")
        _replace_partitions(stay, table)
        for value in (v for v, n in lot if n == 0):
            spec = "NULL" if value is None else "'" + str(value).replace("'", "\\'") + "'"
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({partition} = {spec})")
    return audit


def delete_outside(spark: SparkSession, table: str, partition: str, rings: DataFrame, dry_run: bool = False, **options) -> DataFrame:
    """Delete positions outside the region, and those without a position."""
    def kept(rows: DataFrame) -> DataFrame:
        return within_region(rows, rings, "_inside").where("_inside").drop("_inside")

    return rewrite_partitions(spark, table, partition, kept, dry_run, **options)


def delete_duplicates(spark: SparkSession, table: str, partition: str, dry_run: bool = False, **options) -> DataFrame:
    """Delete repeated reports but for the oldest one; reports that repeat each other lie in one partition if that follows the message time."""
    return rewrite_partitions(spark, table, partition, dedup_reports, dry_run, **options)
