"""Catalog and database tables, and the loading of reference tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewake import schemas
from tidewake.operators.aggregate import code_distribution, null_census
from tidewake.operators.lookups import lookup_with_default
from tidewake.sources.files import clean_column_names, read_reference_csv, write_csv


def load_table(spark: SparkSession, name: str, require: tuple[str, ...] = ()) -> DataFrame:
    """A catalog table; complains about missing columns."""
    df = spark.read.table(name)
    absent = [c for c in require if c not in df.columns]
    if absent:
        raise ValueError(f"table {name} lacks columns: {', '.join(absent)}")
    return df


def load_jdbc(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
              bounds: tuple | None = None, partitions: int = 64, **options: str) -> DataFrame:
    """A database table or ``(query) alias``, read in parallel ranges of ``partition_column``."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if partition_column and bounds:
        reader = reader.options(
            partitionColumn=partition_column, lowerBound=str(bounds[0]), upperBound=str(bounds[1]),
            numPartitions=str(partitions),
        )
    return reader.load()


def save_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", batch: int = 1000, **options: str) -> None:
    df.write.format("jdbc").mode(mode).options(url=url, dbtable=table, batchsize=str(batch), **options).save()


def save_table(df: DataFrame, name: str, mode: str = "overwrite", path: str | None = None) -> None:
    """Write a catalog table; ``mode`` is overwrite, append or ignore."""
    writer = df.write.mode(mode).format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def verify_table(spark: SparkSession, name: str, n: int = 5, order: str | None = None) -> tuple[int, DataFrame]:
    """Row count and a short preview: the first rows by ``order``, or any."""
    df = spark.read.table(name)
    return df.count(), (df.orderBy(order) if order else df).limit(n)


def export_all_tables(spark: SparkSession, directory: str, fmt: str = "csv") -> list[str]:
    """Write every table of the current database to its own folder; returns the table names."""
    names = [t.name for t in spark.catalog.listTables() if not t.isTemporary]
    for name in names:
        target = f"{directory.rstrip('/')}/{name}"
        if fmt == "csv":
            write_csv(spark.read.table(name), target)
        else:
            spark.read.table(name).write.mode("overwrite").format(fmt).save(target)
    return names


def load_if_absent(spark: SparkSession, name: str, make, mode: str = "update", path: str | None = None) -> bool:
    """Create table ``name`` from ``make()`` if there is none, or always with ``mode='recreate'``."""
    if mode == "update" and spark.catalog.tableExists(name):
        return False
    save_table(make(), name, "overwrite", path)
    return True


def nav_status_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(schemas.NAV_STATUS_ROWS, schemas.NAV_STATUS)


def ports_with_scrubber_status(ports: DataFrame, bans: DataFrame) -> DataFrame:
    """Ports with their ban status; unlisted ports have status 0."""
    return lookup_with_default(ports, F.col("port_name"), bans, "port_name", {"scrubber_status": 0})


def import_ports(spark: SparkSession, path: str, bans: DataFrame | None = None) -> DataFrame:
    """A wide port file with all its columns under cleaned names, and the ban status (0 where none is known).

    Column types are inferred, as such files have many columns and a few dozen rows.
    """
    raw = clean_column_names(
        spark.read.option("header", True).option("inferSchema", True).option("nullValue", "NaN")
        .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).csv(path)
    )
    if "port_name" not in raw.columns:
        raise ValueError(f"{path} lacks the column port_name")
    return ports_with_scrubber_status(raw, bans) if bans is not None else raw.withColumn("scrubber_status", F.lit(0))


def port_coordinates(ports: DataFrame, order: str = "port_id") -> DataFrame:
    """One row per upper-case port name with upper-case country; of equal names the last one (by ``order``) counts."""
    named = ports.where(F.col("port_name").isNotNull()).withColumns({"port_name": F.upper("port_name"), "country": F.upper("country")})
    rest = [c for c in ports.columns if c != "port_name"]
    last = named.groupBy("port_name").agg(F.max_by(F.struct(*rest), order).alias("_last"))
    return last.select(*["port_name" if c == "port_name" else F.col("_last")[c].alias(c) for c in ports.columns])


def load_audit(df: DataFrame, code: str) -> DataFrame:
    """What loading a reference table reports: NULLs per column and rows per value of ``code``."""
    nulls = null_census(df).select(F.lit("nulls").alias("kind"), F.col("column_name").alias("name"), F.col("nulls").alias("n"))
    codes = code_distribution(df, code).select(F.lit(code).alias("kind"), F.col(code).cast("string").alias("name"), "n")
    return nulls.unionByName(codes)


def load_reference_tables(spark: SparkSession, directory: str, mode: str = "update", prefix: str = "",
                          path: str | None = None) -> list[str]:
    """Load ship types, ports with their ban status, and navigational statuses as catalog tables.

    ``directory`` holds ``ship_type_codes.csv``, ``ports.csv`` and ``port_bans.csv``.
    Returns the names of the tables that were written.
    """
    def csv(name: str, schema) -> DataFrame:
        return read_reference_csv(spark, f"{directory.rstrip('/')}/{name}.csv", schema)

    makers = {
        "ship_type_codes": lambda: csv("ship_type_codes", schemas.SHIP_TYPE_CODES).where("type_code IS NOT NULL"),
        "ports": lambda: ports_with_scrubber_status(csv("ports", schemas.PORTS), csv("port_bans", schemas.PORT_BANS)),
        "navigational_status": lambda: nav_status_table(spark),
    }
    return [
        name for name, make in makers.items()
        if load_if_absent(spark, prefix + name, make, mode, f"{path.rstrip('/')}/{name}" if path else None)
    ]
