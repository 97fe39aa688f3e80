"""Reports as tidy (section, key, value) tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewake.operators.aggregate import flows_of_cube, top_values
from tidewake.operators.temporal import latest_state
from tidewake.session import materialize


def _section(name: str, df: DataFrame, key, value) -> DataFrame:
    return df.select(
        F.lit(name).alias("section"), key.cast("string").alias("key"), value.cast("double").alias("value")
    )


def movement_report(extract: DataFrame, top: int = 10, top_flows: int = 5) -> DataFrame:
    """Totals, ship types, top destinations, hourly activity, flows and daily ship counts.

    The extract is read twice, for two stored cubes: ships by day, and flows by hour.
    """
    ships = materialize(
        extract.groupBy("has_scrubber", "ship_type", "imo_number", F.to_date("timestamp_collected").alias("date")).agg(
            F.count(F.lit(1)).alias("n"), F.sum("position_count").alias("weight"),
            F.sum("sog").alias("speed"), F.count("sog").alias("speeds"),
        ), "ship_days",
    )
    flows = materialize(
        extract.groupBy("has_scrubber", "ship_type", "destination", F.hour("timestamp_collected").alias("hour")).agg(
            F.count(F.lit(1)).alias("n")), "flow_hours",
    )
    totals = ships.agg(
        F.count_distinct("imo_number").cast("double").alias("ships"), F.sum("n").cast("double").alias("positions"),
        F.try_divide(F.sum("speed"), F.sum("speeds")).cast("double").alias("avg_speed"),
    ).unpivot([], ["ships", "positions", "avg_speed"], "key", "value")
    types = ships.where(F.col("ship_type").isNotNull()).groupBy("ship_type").agg(
        F.count_distinct("imo_number").alias("ships"), F.sum("weight").alias("position_count"))
    destinations = flows.where(F.col("destination").isNotNull()).groupBy("destination").agg(F.sum("n").alias("n"))
    hours = flows.where(F.col("hour").isNotNull()).groupBy("hour").agg(F.sum("n").alias("n"))
    cube = flows.groupBy("has_scrubber", "ship_type", "destination").agg(F.sum("n").alias("n"))
    between = flows_of_cube(cube, top_flows)
    flow_key = F.concat_ws(
        " | ", F.when(F.col("has_scrubber"), "scrubber").otherwise("non_scrubber"), "ship_type", "destination"
    )
    seen = ships.where(F.col("imo_number").isNotNull() & F.col("has_scrubber").isNotNull() & F.col("date").isNotNull())
    daily = seen.select("date", "has_scrubber", "imo_number").distinct().groupBy("date").agg(
        F.count_if(~F.col("has_scrubber")).alias("non_scrubber"), F.count_if("has_scrubber").alias("scrubber"))
    return reduce(DataFrame.unionByName, [
        _section("totals", totals, F.col("key"), F.col("value")),
        _section("ships_of_type", types, F.col("ship_type"), F.col("ships")),
        _section("positions_of_type", types, F.col("ship_type"), F.col("position_count")),
        _section("top_destinations", destinations.orderBy(F.desc("n"), "destination").limit(top), F.col("destination"), F.col("n")),
        _section("hourly_activity", hours, F.col("hour"), F.col("n")),
        _section("flows", between, flow_key, F.col("value")),
        _section("daily_non_scrubber", daily, F.col("date"), F.col("non_scrubber")),
        _section("daily_scrubber", daily, F.col("date"), F.col("scrubber")),
    ])


def latest_positions(extract: DataFrame, order: tuple[str, ...] = ("timestamp_collected", "id")) -> tuple[DataFrame, DataFrame]:
    """(ships with scrubber, ships without): the last known values of each ship."""
    latest = latest_state(extract, "imo_number", list(order))
    return latest.where("has_scrubber"), latest.where("NOT has_scrubber")


def destination_report(normalized: DataFrame) -> DataFrame:
    """Row counts of all primary and secondary destinations."""
    return reduce(DataFrame.unionByName, [
        _section(name, top_values(normalized, column), F.col(column), F.col("n"))
        for name, column in (("primary", "destination"), ("secondary", "secondary_destination"))
    ])
