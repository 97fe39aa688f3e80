"""Distributions, counts, flows and audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewake.session import materialize


def top_values(df: DataFrame, column: str, n: int | None = None) -> DataFrame:
    """Row count per value, most frequent first, ties by value; NULL is no value."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    ordered = counts.orderBy(F.desc("n"), F.asc(column))
    return ordered.limit(n) if n else ordered


def type_distribution(df: DataFrame) -> DataFrame:
    """Distinct ships and summed position counts per ship type, most ships first."""
    return (
        df.where(F.col("ship_type").isNotNull())
        .groupBy("ship_type")
        .agg(F.count_distinct("imo_number").alias("ships"), F.sum("position_count").alias("position_count"))
        .orderBy(F.desc("ships"), "ship_type")
    )


def position_weight(df: DataFrame) -> DataFrame:
    """Summed position counts per ship type and scrubber flag."""
    known = df.where(F.col("ship_type").isNotNull())
    return known.groupBy("ship_type", "has_scrubber").agg(F.sum("position_count").alias("position_count"))


def hourly_activity(df: DataFrame, ts: str = "timestamp_collected") -> DataFrame:
    return df.where(F.col(ts).isNotNull()).groupBy(F.hour(ts).alias("hour")).agg(F.count(F.lit(1)).alias("n"))


def global_stats(df: DataFrame) -> DataFrame:
    """One row: distinct ships, positions, mean speed."""
    return df.agg(
        F.count_distinct("imo_number").alias("ships"), F.count(F.lit(1)).alias("positions"),
        F.avg("sog").alias("avg_speed"),
    )


def daily_unique_pivot(df: DataFrame, ts: str = "timestamp_collected") -> DataFrame:
    """Distinct ships per day without and with scrubber, 0 where none."""
    seen = df.where(F.col("imo_number").isNotNull() & F.col("has_scrubber").isNotNull() & F.col(ts).isNotNull())
    ship_days = seen.select(F.to_date(ts).alias("date"), "has_scrubber", "imo_number").distinct()
    return ship_days.groupBy("date").agg(
        F.count_if(~F.col("has_scrubber")).alias("non_scrubber"), F.count_if("has_scrubber").alias("scrubber")
    )


def daily_ship_counts(df: DataFrame, ts: str = "timestamp_collected") -> DataFrame:
    """Distinct ships per day; rows without a time belong to no day."""
    return df.where(F.col(ts).isNotNull()).groupBy(F.to_date(ts).alias("date")).agg(F.count_distinct("imo_number").alias("ships"))


def null_census(df: DataFrame) -> DataFrame:
    """Number of NULLs per column, counted in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column_name", "nulls")


def code_distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows per code; NULL is no code."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def unprocessed_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows in total, and rows where any of the derived columns is still NULL."""
    pending = F.lit(False)
    for column in columns:
        pending = pending | F.col(column).isNull()
    return df.agg(F.count(F.lit(1)).alias("total_records"), F.count_if(pending).alias("unprocessed_records"))


def retention_audit(df: DataFrame, kept: Column) -> DataFrame:
    """Counts and percentages of kept and deleted rows; 0 % of an empty table."""
    counts = df.agg(F.count(F.lit(1)).alias("total"), F.count_if(kept).alias("kept"))
    counts = counts.withColumn("deleted", F.col("total") - F.col("kept"))

    def percent(part: str) -> Column:
        share = F.try_divide(F.col(part) * F.lit(100.0), F.col("total"))
        return F.coalesce(share, F.lit(0.0)).alias(f"{part}_percent")

    return counts.select("*", percent("kept"), percent("deleted"))


# ----------------------------------------------------------------------- flows

def _top(cube: DataFrame, column: str, n: int) -> DataFrame:
    """The ``n`` most frequent values with their rank (0 first); at most ``n`` rows."""
    counts = cube.where(F.col(column).isNotNull()).groupBy(column).agg(F.sum("n").alias("_freq"))
    few = counts.orderBy(F.desc("_freq"), column).limit(n)
    ranked = Window.orderBy(F.desc("_freq"), column)
    return few.select(column, (F.row_number().over(ranked) - 1).alias(f"{column}_rank"))


def flow_rows(df: DataFrame, top_n: int = 5) -> DataFrame:
    """Row counts from ship type to destination per scrubber flag.

    Types and destinations are the most frequent of all ships. One pass counts
    the (flag, type, destination) combinations; rankings and flows come from
    that small cube, which is stored.
    """
    return flows_of_cube(materialize(
        df.groupBy("has_scrubber", "ship_type", "destination").agg(F.count(F.lit(1)).alias("n")), "flow_cube"
    ), top_n)


def flows_of_cube(cube: DataFrame, top_n: int = 5) -> DataFrame:
    """The same from counts ``n`` per flag, type and destination."""
    return (
        cube.where(F.col("has_scrubber").isNotNull())
        .join(F.broadcast(_top(cube, "ship_type", top_n)), "ship_type", "left_semi")
        .join(F.broadcast(_top(cube, "destination", top_n)), "destination", "left_semi")
        .select("has_scrubber", "ship_type", "destination", F.col("n").alias("value"))
    )


def flow_unique_ships(df: DataFrame, flag: bool, top_n: int = 5) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(flows, ranked types, ranked destinations) of distinct ships within one flag group.

    Destinations are ranked over primary and secondary values together. Flows to
    primary and to secondary destinations stay separate rows (``leg``). The
    (type, destinations, ship) combinations are counted in one pass and stored.
    """
    group = df.where(F.col("has_scrubber") == flag)
    cube = materialize(
        group.groupBy("ship_type", "destination", "secondary_destination", "imo_number").agg(
            F.count(F.lit(1)).alias("n")
        ), "flow_cube",
    )
    both = cube.select("destination", "n").unionByName(
        cube.select(F.col("secondary_destination").alias("destination"), "n")
    )
    types, destinations = _top(cube, "ship_type", top_n), _top(both, "destination", top_n)

    def leg(name: str, column: str) -> DataFrame:
        flows = (
            cube.select("ship_type", F.col(column).alias("destination"), "imo_number")
            .join(F.broadcast(types), "ship_type")
            .join(F.broadcast(destinations), "destination")
        )
        return flows.groupBy("ship_type", "destination", "ship_type_rank", "destination_rank").agg(
            F.count_distinct("imo_number").alias("value")
        ).withColumn("leg", F.lit(name))

    flows = leg("primary", "destination").unionByName(leg("secondary", "secondary_destination"))
    return flows, types, destinations


def flow_links(flows: DataFrame, types: DataFrame, destinations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, links) of a flow diagram: types are numbered first, then destinations, by rank."""
    n_types = types.select(F.count(F.lit(1))).scalar()
    nodes = types.select(F.col("ship_type_rank").cast("long").alias("node"), F.upper("ship_type").alias("label"))
    targets = destinations.select((F.col("destination_rank") + n_types).alias("node"), F.col("destination").alias("label"))
    links = flows.select(
        F.col("ship_type_rank").cast("long").alias("source"), (F.col("destination_rank") + n_types).alias("target"),
        "value", "leg",
    )
    return nodes.unionByName(targets), links


def profile_flows(df: DataFrame, top_n: int = 5) -> DataFrame:
    """Row counts between the most frequent types and destinations of one group of ships."""
    return profile_flow_tables(df, top_n)[0].select("ship_type", "destination", "value")


def profile_flow_tables(df: DataFrame, top_n: int = 5) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(flows, ranked types, ranked destinations) by rows, ready for :func:`flow_links`."""
    cube = materialize(df.groupBy("ship_type", "destination").agg(F.count(F.lit(1)).alias("n")), "flow_cube")
    types, destinations = _top(cube, "ship_type", top_n), _top(cube, "destination", top_n)
    flows = cube.join(F.broadcast(types), "ship_type").join(F.broadcast(destinations), "destination")
    return flows.withColumnsRenamed({"n": "value"}).withColumn("leg", F.lit("profile")), types, destinations


# -------------------------------------------------------------------- sampling

def stratified_sample(
    df: DataFrame, column: str, fractions: dict[str, float], row_id: str, seed: int = 42,
) -> DataFrame:
    """Exactly ``round(fraction * n)`` rows of each listed stratum, the same ones on every run.

    Rows are ordered by a hash of (seed, id). The first four hex digits divide a
    stratum into 65,536 cells; counting cells tells which ones are wholly in or
    out, so only the one cell at the border needs its rows ranked. ``row_id``
    is unique.
    """
    share = F
    for stratum, fraction in fractions.items():
        share = share.when(F.col(column) == stratum, F.lit(float(fraction)))
    hashed = df.where(F.col(column).isin(list(fractions))).select(
        row_id, column, F.md5(F.concat(F.lit(f"{seed}:"), F.col(row_id).cast("string"))).alias("_h")
    ).withColumn("_cell", F.substring("_h", 1, 4))
    # Stored: the cells are counted, taken whole and ranked from the ids alone.
    hashed = materialize(hashed, "strata")
    cells = hashed.groupBy(column, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    by_stratum = Window.partitionBy(column)
    before = by_stratum.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    quota = F.rint(F.sum("_n").over(by_stratum) * share).cast("long")
    cells = cells.select(
        column, "_cell", "_n", (quota - F.coalesce(F.sum("_n").over(before), F.lit(0))).alias("_left")
    ).where(F.col("_left") > 0)
    # At most 65,536 cells per listed stratum.
    placed = hashed.join(F.broadcast(cells), [column, "_cell"])
    whole = placed.where(F.col("_left") >= F.col("_n"))
    rank = F.row_number().over(Window.partitionBy(column, "_cell").orderBy("_h", row_id))
    border = placed.where(F.col("_left") < F.col("_n")).withColumn("_rank", rank).where("_rank <= _left")
    chosen = whole.select(row_id).unionByName(border.select(row_id))
    return df.where(F.col(column).isin(list(fractions))).join(chosen, row_id, "left_semi").select(*df.columns)
