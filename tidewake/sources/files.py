"""CSV and Parquet sources and sinks, column names and identifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_reference_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Headered CSV whose columns are found by name; blank fields and the text NaN are NULL.

    The order of the columns doesn't matter and others may be there; a missing
    one is an error. Values that don't fit their declared type are NULL.
    """
    reader = spark.read.option("header", True).option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
    raw = reader.csv(path)
    raw = raw.toDF(*[clean_name(c) for c in raw.columns])
    absent = [f.name for f in schema.fields if f.name not in raw.columns]
    if absent:
        raise ValueError(f"{path} lacks columns: {', '.join(absent)}")

    def value(field: T.StructField) -> Column:
        text = F.when(~F.upper(field.name).isin("NAN", ""), F.col(field.name))
        if isinstance(field.dataType, T.IntegralType):
            # Whole numbers may be written with a fraction of zero.
            number = text.try_cast("double")
            return F.coalesce(text.try_cast(field.dataType), F.when(number == F.floor(number), number.try_cast(field.dataType)))
        return text.try_cast(field.dataType)

    return raw.select(*[value(f).alias(f.name) for f in schema.fields])


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def read_extract(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_extract(df: DataFrame, path: str, partition_by: tuple[str, ...] = ("date",), mode: str = "overwrite",
                  ts: str = "timestamp_collected") -> None:
    """Parquet partitioned by date, so that later time filters skip whole folders.

    Rows are rebalanced by date before writing: adaptive execution merges small
    dates and splits large ones, so files are even and no date is one task's work.
    """
    if "date" in partition_by and "date" not in df.columns:
        df = df.withColumn("date", F.to_date(ts))
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def clean_name(name: str) -> str:
    """Lower case, spaces as underscores, no parentheses or commas."""
    cleaned = name.strip().replace(" ", "_")
    return "".join(ch for ch in cleaned if ch not in "(),").lower()


def clean_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[clean_name(c) for c in df.columns])


def coerce_identifier_columns(df: DataFrame, patterns: tuple[str, ...] = ("imo", "mmsi")) -> DataFrame:
    """Identifier columns become whole numbers with 0 for missing.

    Values that no whole number can take, infinite or too large ones, turn their
    column into text, as it is only there that they can be kept; missing values
    are then ''. Text columns stay as they are. Columns of a type that can hold
    such values are looked at once, all in one pass.
    """
    wide = [f.name for f in df.schema.fields if any(p in f.name.lower() for p in patterns)
            and isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType))]
    unfit = set()
    if wide:
        def fails(name: str) -> Column:
            number = F.col(f"`{name}`").cast("double")
            return F.coalesce(F.bool_or(~F.isnan(number) & number.try_cast("bigint").isNull() & number.isNotNull()), F.lit(False))

        found = df.agg(*[fails(c).alias(f"c{i}") for i, c in enumerate(wide)]).first()
        unfit = {c for c, bad in zip(wide, found) if bad}

    def coerced(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if not any(p in field.name.lower() for p in patterns) or not isinstance(field.dataType, T.NumericType):
            return column
        if field.name in unfit:
            return F.when(column.isNull() | F.isnan(column.cast("double")), "").otherwise(column.cast("string")).alias(field.name)
        number = F.nanvl(column.cast("double"), F.lit(None)) if isinstance(
            field.dataType, (T.DoubleType, T.FloatType)) else column
        return F.coalesce(number.try_cast("bigint"), F.lit(0)).cast("bigint").alias(field.name)

    return df.select(*[coerced(f) for f in df.schema.fields])


def reconcile_schema(df: DataFrame, target: T.StructType, defaults: dict[str, object] | None = None) -> DataFrame:
    """Add missing columns as typed NULL (or their default); keep extra columns behind them."""
    defaults = defaults or {}
    missing = [f for f in target.fields if f.name not in df.columns]
    added = df.withColumns({
        f.name: F.lit(defaults.get(f.name)).cast(f.dataType) for f in missing
    }) if missing else df
    extra = [c for c in df.columns if c not in target.fieldNames()]
    return added.select(*target.fieldNames(), *extra)


def reset_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Empty derived columns, so that everything is processed again."""
    return df.withColumns({c: F.lit(None).cast("string") for c in columns})
