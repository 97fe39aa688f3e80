"""Operators that depend on the time order of the rows of a key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewake.functions.ais import seconds_between
from tidewake.operators.ranges import split_large_keys


def hours_since_previous(
    df: DataFrame, key: str = "imo_number", ts: str = "timestamp_collected", tie: str = "id",
    piece_rows: int | None = None,
) -> DataFrame:
    """Add ``time_diff``: hours since the previous row of the key, NULL for its first row and without a key."""
    pieces = split_large_keys(df, [key], ts, tie, piece_rows=piece_rows).carry(F.max(ts), F.max)
    order = pieces.window(F.col(ts).asc_nulls_first(), tie)
    previous = F.coalesce(F.lag(ts).over(order), F.col("_carry"))
    hours = seconds_between(F.col("_previous"), F.col(ts)) / 3600
    return pieces.df.withColumn("_previous", previous).select(
        *df.columns, F.when(F.col(key).isNotNull(), hours).alias("time_diff")
    )


def systematic_sample(
    df: DataFrame, keys: list[str], ts: str, every: int, tie: str = "id", piece_rows: int | None = None,
) -> DataFrame:
    """Keep rows 1, 1 + every, 1 + 2 * every, ... of each key in time order.

    The test is ``row_number % every = 1``; with ``every=1`` nothing passes.
    """
    pieces = split_large_keys(df, keys, ts, tie, piece_rows=piece_rows).carry(F.count(F.lit(1)), F.sum)
    order = pieces.window(F.col(ts).asc_nulls_first(), tie)
    row_num = F.row_number().over(order) + F.coalesce(F.col("_carry"), F.lit(0))
    return pieces.df.withColumn("_row_num", row_num).where(F.col("_row_num") % every == 1).select(*df.columns)


def chunk_of(ts, start, days: int):
    """Number of the ``days``-long chunk since ``start`` that holds ``ts``."""
    elapsed = seconds_between(F.lit(start).cast("timestamp_ntz"), ts)
    return F.floor(elapsed / (days * 86400)).cast("int")


def asof_last(
    left: DataFrame, right: DataFrame, key: str, ts: str, tie: str, value: list[str],
    piece_rows: int | None = None, include_equal: bool = True,
) -> DataFrame:
    """Add to each left row the ``value`` columns (and ``asof_ts``) of the last right row before it.

    Both sides are merged into one time-ordered stream per key and the last
    right row is carried forward, so no pairs arise.
    With ``include_equal`` a right row of the same time counts as before.
    Left rows with a NULL key find nothing.
    """
    payload = F.struct(F.col(ts).alias("t"), F.col(tie).alias("tie"), *value)
    seen = right.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(
        key, F.col(ts).alias("_t"), F.lit(0 if include_equal else 2).alias("_side"),
        F.col(tie).alias("_tie"), payload.alias("_seen"), F.lit(None).alias("_row"),
    )
    asked = left.select(
        key, F.col(ts).alias("_t"), F.lit(1).alias("_side"), (F.col(tie) if tie in left.columns else F.lit(None)).alias("_tie"),
        F.lit(None).alias("_seen"), F.struct(*left.columns).alias("_row"),
    )
    pieces = split_large_keys(seen.unionByName(asked), [key], "_t", "_side", "_tie", piece_rows=piece_rows).carry(F.max("_seen"), F.max)
    so_far = pieces.window("_t", "_side", "_tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.coalesce(F.last("_seen", ignorenulls=True).over(so_far), F.col("_carry"))
    found = pieces.df.withColumn("_last", F.when(F.col(key).isNotNull(), last)).where(F.col("_row").isNotNull())
    return found.select(
        *[F.col("_row")[c].alias(c) for c in left.columns],
        F.col("_last.t").alias("asof_ts"),
        *[F.col("_last")[c].alias(f"asof_{c}") for c in value],
    )


def asof_latest_within(
    left: DataFrame, right: DataFrame, key: str, ts: str, tie: str, value: str,
    max_age_seconds: float, piece_rows: int | None = None,
) -> DataFrame:
    """Add ``recent_<value>`` from the last right row that is younger than ``max_age_seconds``.

    The last right row decides: if it is too old, or its value is NULL, the result is NULL.
    """
    found = asof_last(left, right, key, ts, tie, [value], piece_rows)
    fresh = seconds_between(F.col("asof_ts"), F.col(ts)) < max_age_seconds
    return found.select(*left.columns, F.when(fresh, F.col(f"asof_{value}")).alias(f"recent_{value}"))


def latest_within(df: DataFrame, key: str, ts: str, tie: str, value: str, as_of, hours: int) -> DataFrame:
    """Value of the newest row per key among the rows of the last ``hours`` before ``as_of``."""
    end = F.lit(as_of).cast("timestamp_ntz")
    recent = df.where((F.col(ts) > end - F.make_dt_interval(hours=F.lit(hours))) & (F.col(ts) <= end))
    return recent.groupBy(key).agg(F.max_by(value, F.struct(ts, tie)).alias(value))


def latest_state(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per key with the last non-NULL value of every column."""
    newest = F.struct(*order)
    others = [c for c in df.columns if c != key]
    picked = [F.max(F.when(F.col(c).isNotNull(), F.struct(newest.alias("o"), F.col(c).alias("v")))) for c in others]
    grouped = df.where(F.col(key).isNotNull()).groupBy(key).agg(*[p.alias(c) for p, c in zip(picked, others)])
    return grouped.select(*[key if c == key else F.col(c)["v"].alias(c) for c in df.columns])


def first_per_key(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key; NULL keys form a group of their own.

    A plain aggregate, so copies are merged before the shuffle.
    """
    rest = [c for c in df.columns if c not in key]
    picked = df.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_first"))
    return picked.select(*[c if c in key else F.col("_first")[c].alias(c) for c in df.columns])


# The columns that make two reports the same.
REPORT_KEYS = [
    "imo_number", "timestamp_ais", "latitude", "longitude", "destination", "sog", "cog",
    "navigational_status", "rate_of_turn",
]


def dedup_reports(
    df: DataFrame, keys: list[str] | None = None, order: tuple[str, ...] = ("timestamp_collected", "id"),
) -> DataFrame:
    """Keep the oldest of the reports that agree in all key columns; NULLs agree with each other."""
    return first_per_key(df, list(keys or REPORT_KEYS), list(order))


def lag_features(
    df: DataFrame, series: str, date: str, value: str, lags: tuple[int, ...] = (1, 7, 14),
) -> DataFrame:
    """Weekday, month, day and earlier values of each series; rows with any gap are dropped.

    ``df`` holds one row per series and date, so a series is as long as its calendar.
    """
    order = Window.partitionBy(series).orderBy(date)
    return df.select(
        "*", F.weekday(date).alias("day_of_week"), F.month(date).alias("month"), F.dayofmonth(date).alias("day"),
        *[F.lag(value, k).over(order).alias(f"lag_{k}") for k in lags],
    ).dropna()


def trailing_values(df: DataFrame, series: str, date: str, value: str, n: int = 14) -> DataFrame:
    """The last ``n`` values of each series as an array, oldest first."""
    newest_first = Window.partitionBy(series).orderBy(F.col(date).desc())
    last = df.withColumn("_rank", F.row_number().over(newest_first)).where(F.col("_rank") <= n)
    pairs = F.sort_array(F.collect_list(F.struct(F.col(date).alias("d"), F.col(value).alias("v"))))
    return last.groupBy(series).agg(F.transform(pairs, lambda p: p["v"]).alias("trailing"))


def future_calendar(df: DataFrame, series: str, date: str, horizon: int = 31, offset: int = 0) -> DataFrame:
    """Consecutive days per series from its last date (plus ``offset`` days) on, with date parts."""
    last = df.groupBy(series).agg(F.max(date).alias("_last"))
    days = F.sequence(F.date_add("_last", offset), F.date_add("_last", offset + horizon - 1))
    return last.select(series, F.posexplode(days).alias("step", "date")).select(
        series, "step", "date", F.weekday("date").alias("day_of_week"), F.month("date").alias("month"),
        F.dayofmonth("date").alias("day"),
    )


def oldest_unprocessed(df: DataFrame, pending, order: list[str], n: int, distinct: list[str] | None = None) -> DataFrame:
    """Work queue: the first ``n`` rows that still await processing, one for each value of ``distinct``."""
    waiting = df.where(pending)
    if distinct:
        waiting = first_per_key(waiting, distinct, [*order, *[c for c in df.columns if c not in order]])
    return waiting.orderBy(*order).limit(n)


def recent(df: DataFrame, ts: str, as_of, days: int) -> DataFrame:
    """Rows of the ``days`` days before the date of ``as_of``, and later ones."""
    first_day = F.date_sub(F.to_date(F.lit(as_of)), days)
    return df.where(F.col(ts) >= first_day.cast("timestamp_ntz"))

