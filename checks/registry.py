"""Registry of check queries: a Spark query over the fixtures and, where SQL can say it, its oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.fixtures import Fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def printable(df: DataFrame) -> DataFrame:
    """Times and dates as text, so that both engines return the same values."""
    def shown(field: T.StructField):
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(field.name, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return F.col(field.name).cast("string").alias(field.name)
        return F.col(field.name)

    return df.select(*[shown(f) for f in df.schema.fields])


def query(name: str, sql: str | None = None):
    """Register ``build(fixtures)`` as query ``name``, with its oracle."""
    def register(build: Callable[[Fixtures], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: printable(build(Fixtures(spark, sf_dir)))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})
