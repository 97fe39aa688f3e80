"""Time-ordered operators on skewed keys: pieces of any size give the same, and brute force agrees."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidewake.operators import aggregate, ranges, temporal

START = dt.datetime(2024, 1, 1)
SCHEMA = "id long, imo_number long, timestamp_collected timestamp_ntz, destination string"


@pytest.fixture
def skewed(spark):
    """One ship with half of the rows, bursts of equal times, a NULL ship, ships with one row."""
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        ship = 1 if i % 2 else rng.choice([2, 3, 4, None, 100 + i])
        second = rng.choice([7, 7, 7, rng.randrange(1_000_000)])
        rows.append((i, ship, START + dt.timedelta(seconds=second), rng.choice([None, "A", "B"])))
    return spark.createDataFrame(rows, SCHEMA), rows


def test_hours_since_previous(skewed, same):
    df, rows = skewed
    whole = temporal.hours_since_previous(df)
    same(whole, temporal.hours_since_previous(df, piece_rows=40))
    last, expected = {}, {}
    for i, ship, at, _ in sorted(rows, key=lambda r: (r[2], r[0])):
        expected[i] = (at - last[ship]).total_seconds() / 3600 if ship in last else None
        if ship is not None:
            last[ship] = at
    found = {r["id"]: r["time_diff"] for r in whole.collect()}
    assert all(found[i] == pytest.approx(e) if e is not None else found[i] is None for i, e in expected.items())


@pytest.mark.parametrize("every", [1, 2, 7])
def test_systematic_sample(skewed, same, every):
    df, rows = skewed
    whole = temporal.systematic_sample(df, ["imo_number"], "timestamp_collected", every)
    same(whole, temporal.systematic_sample(df, ["imo_number"], "timestamp_collected", every, piece_rows=40))
    by_ship = {}
    for i, ship, at, _ in sorted(rows, key=lambda r: (r[2], r[0])):
        by_ship.setdefault(ship, []).append(i)
    expected = [i for ids in by_ship.values() for n, i in enumerate(ids, 1) if n % every == 1]
    assert sorted(r["id"] for r in whole.collect()) == sorted(expected)


def test_asof(skewed, same):
    df, rows = skewed
    left, right = df.where("id % 3 <> 0"), df.where("id % 3 = 0")
    args = ("imo_number", "timestamp_collected", "id", "destination", 3600.0)
    whole = temporal.asof_latest_within(left, right, *args)
    same(whole, temporal.asof_latest_within(left, right, *args, piece_rows=40))
    found = {r["id"]: r["recent_destination"] for r in whole.collect()}
    for i, ship, at, _ in rows:
        if i % 3 == 0:
            continue
        seen = [(t, j, d) for j, s, t, d in rows if j % 3 == 0 and s == ship and s is not None and t <= at]
        last = max(seen, key=lambda x: x[:2], default=None)
        expected = last[2] if last and (at - last[0]).total_seconds() < 3600 else None
        assert found[i] == expected


def largest_piece(df, by):
    return df.groupBy(*by).count().agg(F.max("count")).first()[0]


def test_pieces_are_even(skewed):
    """A ship with half of the rows is cut into many pieces, in time order; small ones are left whole."""
    df, _ = skewed
    pieces = ranges.split_large_keys(df, ["imo_number"], "timestamp_collected", "id", piece_rows=100)
    assert pieces.df.count() == 3000 and largest_piece(pieces.df, pieces.by) <= 100
    assert pieces.df.where("imo_number > 10").select(ranges.PIECE).distinct().collect() == [(-1,)]
    spans = pieces.df.where("imo_number = 1").groupBy(ranges.PIECE).agg(
        F.min("timestamp_collected").alias("low"), F.max("timestamp_collected").alias("high")).orderBy(ranges.PIECE).collect()
    assert len(spans) > 15
    assert all(x.high <= y.low for x, y in zip(spans, spans[1:]))


def test_rows_of_one_time_are_cut(spark, same):
    """All rows of a ship share one time; the id cuts them."""
    rows = [(i, 1, START, None) for i in range(4000)]
    df = spark.createDataFrame(rows, SCHEMA)
    pieces = ranges.split_large_keys(df, ["imo_number"], "timestamp_collected", "id", piece_rows=200)
    assert largest_piece(pieces.df, pieces.by) <= 300
    sample = temporal.systematic_sample(df, ["imo_number"], "timestamp_collected", 10, piece_rows=200)
    assert sorted(r["id"] for r in sample.collect()) == list(range(0, 4000, 10))
    gaps = temporal.hours_since_previous(df, piece_rows=200).groupBy("time_diff").count().collect()
    assert {r["time_diff"]: r["count"] for r in gaps} == {None: 1, 0.0: 3999}


def test_many_large_keys(spark):
    """Every ship is large."""
    df = spark.range(20_000).select(
        "id", (F.col("id") % 6).alias("imo_number"), F.timestamp_seconds(F.col("id") * 10).cast("timestamp_ntz").alias("timestamp_collected"))
    pieces = ranges.split_large_keys(df, ["imo_number"], "timestamp_collected", "id", piece_rows=500)
    assert largest_piece(pieces.df, pieces.by) <= 750
    gaps = temporal.hours_since_previous(df, piece_rows=500)
    assert {round(r["time_diff"] * 3600) if r["time_diff"] is not None else None for r in gaps.collect()} == {None, 60}


def test_number_of_pieces_is_bounded(spark, monkeypatch):
    """Pieces grow with the table: what is broadcast does not."""
    monkeypatch.setattr(ranges, "LEAST_ROWS", 10)
    monkeypatch.setattr(ranges, "MOST_PIECES", 8)
    for n in (1_000, 30_000):
        df = spark.range(n).select("id", F.lit(1).alias("imo_number"), F.lit(None).cast("timestamp_ntz").alias("timestamp_collected"))
        pieces = ranges.split_large_keys(df, ["imo_number"], "timestamp_collected", "id")
        assert 4 <= pieces.df.select(ranges.PIECE).distinct().count() <= 3 * 8
        sample = temporal.systematic_sample(df, ["imo_number"], "timestamp_collected", 10)
        assert sample.agg(F.sum("id")).first()[0] == sum(range(0, n, 10))


def test_many_pieces_are_not_broadcast(skewed, same, monkeypatch):
    """A named size that makes more pieces than MOST_PIECES allows: neither borders nor summaries go to every task."""
    df, _ = skewed
    left, right = df.where("id % 3 <> 0"), df.where("id % 3 = 0")
    makers = (
        lambda rows: temporal.hours_since_previous(df, piece_rows=rows),
        lambda rows: temporal.systematic_sample(df, ["imo_number"], "timestamp_collected", 7, piece_rows=rows),
        lambda rows: temporal.asof_latest_within(left, right, "imo_number", "timestamp_collected", "id", "destination", 3600.0, piece_rows=rows),
    )
    monkeypatch.setattr(ranges, "MOST_PIECES", 100)
    for make in makers:
        found = make(3)
        assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
        same(make(None), found)
    pieces = ranges.split_large_keys(df, ["imo_number"], "timestamp_collected", "id", piece_rows=3)
    assert largest_piece(pieces.df.where("_piece >= 0"), pieces.by) == 3


@pytest.mark.parametrize("piece_rows", [None, 40])
def test_one_exchange_of_the_rows(skewed, piece_rows):
    """Rows go through one hash exchange, by key and piece, whether keys are cut or not."""
    df, _ = skewed
    left, right = df.where("id % 3 <> 0"), df.where("id % 3 = 0")
    for found in (
        temporal.hours_since_previous(df, piece_rows=piece_rows),
        temporal.systematic_sample(df, ["imo_number"], "timestamp_collected", 7, piece_rows=piece_rows),
        temporal.asof_latest_within(left, right, "imo_number", "timestamp_collected", "id", "destination", 3600.0, piece_rows=piece_rows),
    ):
        plan = found._jdf.queryExecution().executedPlan().toString()
        exchanges = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
        # Where keys are cut, the summaries of their pieces are exchanged as well: by piece, and then by key.
        assert "rangepartitioning" not in plan and len(exchanges) == (1 if piece_rows is None else 3), plan
        assert piece_rows is None or sum("_piece" in x for x in exchanges) == 2


def test_empty_input(skewed):
    df = skewed[0].limit(0)
    assert temporal.hours_since_previous(df).count() == 0
    assert temporal.latest_state(df, "imo_number", ["timestamp_collected", "id"]).count() == 0
    assert aggregate.global_stats(df.withColumn("sog", F.lit(1.0))).first()["ships"] == 0


def test_dedup_treats_nulls_as_equal(spark):
    rows = [(2, None, START, "A"), (1, None, START, "A"), (3, 5, START, None), (4, 5, START, None), (5, 5, START, "B")]
    df = spark.createDataFrame(rows, SCHEMA)
    kept = temporal.dedup_reports(df, ["imo_number", "destination"], ("timestamp_collected", "id"))
    assert sorted(r["id"] for r in kept.collect()) == [1, 3, 5]


def test_latest_state_takes_last_known_value(spark):
    rows = [(1, 9, START, "A"), (2, 9, START + dt.timedelta(hours=1), None)]
    state = temporal.latest_state(spark.createDataFrame(rows, SCHEMA), "imo_number", ["timestamp_collected", "id"])
    assert tuple(state.first()) == (2, 9, START + dt.timedelta(hours=1), "A")


def test_stratified_sample_is_exact(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, "T").when(F.col("id") % 3 == 1, "C").alias("kind"))
    sample = aggregate.stratified_sample(df, "kind", {"T": 0.18, "C": 0.13}, "id")
    counts = {r["kind"]: r["count"] for r in sample.groupBy("kind").count().collect()}
    assert counts == {"T": round(1667 * 0.18), "C": round(1667 * 0.13)}
    again = aggregate.stratified_sample(df.repartition(7), "kind", {"T": 0.18, "C": 0.13}, "id")
    assert {r["id"] for r in sample.collect()} == {r["id"] for r in again.collect()}
    assert sample.select("id").distinct().count() == sum(counts.values())
