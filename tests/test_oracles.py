"""Every registered query against its DuckDB oracle on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from tests.conftest import SMALL

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in Path(SMALL).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    return repr(v)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, duck, name):
    df = contract.queries()[name](spark, SMALL)
    columns = sorted(df.columns)
    rows = sorted(tuple(value(v) for v in r) for r in df.select(*columns).collect())
    oracle = contract.oracle_sql().get(name)
    if oracle is None:
        assert name.startswith(("forecast_", "op", "pipeline")) and rows
        return
    relation = duck.sql(oracle)
    assert sorted(relation.columns) == columns
    at = [relation.columns.index(c) for c in columns]
    kinds = dict(zip(relation.columns, map(str, relation.types)))
    assert {c: TYPES[t] for c, t in df.dtypes} == kinds
    assert rows == sorted(tuple(value(r[i]) for i in at) for r in relation.fetchall())


def test_entry(spark):
    assert contract.entry(spark).columns == ["date", "country", "pollution"]
    assert contract.entry(spark).count() > 0
