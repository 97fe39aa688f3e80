"""Scrubber discharge by country and day under port and country rules."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewake.functions.ais import MODES, emission_for_interval, rate_of_mode, sum_or_zero
from tidewake.operators.regions import is_inland
from tidewake.operators.spatial import any_site_within, nearest_site
from tidewake.operators.temporal import hours_since_previous


@dataclass(frozen=True)
class PortRule:
    """Near this port no discharge at berth ('berth'), or at berth and at anchor ('port')."""

    port_name: str
    restriction: str


@dataclass(frozen=True)
class CountryRule:
    """No discharge within ``distance_nm`` of any port ('distance'), or inland ('inland_port')."""

    country: str
    restriction: str
    distance_nm: float | None = None


# The rules as published. Country names do not match the two-letter
# codes of the port table, so these country rules never apply; ISO_COUNTRY_RULES do.
PORT_RULES = (
    PortRule("TILBURY", "berth"),
    PortRule("LEITH", "port"),
    PortRule("DUNDEE", "port"),
    PortRule("AMSTERDAM", "berth"),
)
COUNTRY_RULES = (
    CountryRule("FRANCE", "distance", 3),
    CountryRule("BELGIUM", "distance", 3),
    CountryRule("GERMANY", "inland_port"),
)
ISO_COUNTRY_RULES = (
    CountryRule("FR", "distance", 3),
    CountryRule("BE", "distance", 3),
    CountryRule("DE", "inland_port"),
)
MODES_OF_RESTRICTION = {"berth": ["Berth"], "port": ["Berth", "Anchor"]}
PORT_RADIUS_NM = 3
COUNTRY_RADIUS_NM = 12
INTERNATIONAL = "INTERNATIONAL"


def with_nearest_port(df: DataFrame, ports: DataFrame) -> DataFrame:
    """Add nearest port id, its country (upper case) and its distance."""
    return nearest_site(df, ports.withColumn("country", F.upper("country")))


def discharge_allowed(
    df: DataFrame, ports: DataFrame, port_rules=PORT_RULES, country_rules=COUNTRY_RULES,
    land: DataFrame | None = None,
) -> DataFrame:
    """Add ``discharge_allowed``; needs ``operation_mode``. Rows without a position are allowed.

    The nearest port decides which country rule applies. Whether *any* port is
    within a distance is the same as whether the nearest one is, so one nearest
    port search serves the country rules, and one per kind of port rule the rest.
    """
    if "nearest_nm" not in df.columns:
        columns = df.columns
        allowed = discharge_allowed(with_nearest_port(df, ports), ports, port_rules, country_rules, land)
        return allowed.select(*columns, "discharge_allowed")
    columns, blocks = df.columns, []
    for restriction, modes in MODES_OF_RESTRICTION.items():
        names = [r.port_name for r in port_rules if r.restriction == restriction]
        if names:
            ruled = ports.where(F.upper("port_name").isin(names))
            df = any_site_within(df, ruled, PORT_RADIUS_NM, f"_near_{restriction}")
            blocks.append(F.col(f"_near_{restriction}") & F.col("operation_mode").isin(modes))
    for rule in country_rules:
        here = F.col("nearest_country") == rule.country
        if rule.restriction == "distance":
            blocks.append(here & (F.col("nearest_nm") <= rule.distance_nm))
        elif land is None:
            # Harmless only while no port has the rule's country.
            if not ports.where(F.upper("country") == rule.country).isEmpty():
                raise ValueError(f"the inland rule of {rule.country} needs the land polygons")
        else:
            if "_inland" not in df.columns:
                df = is_inland(df, land, "_inland")
            blocks.append(here & F.col("_inland"))
    blocked = reduce(lambda a, b: a | b, [F.coalesce(b, F.lit(False)) for b in blocks], F.lit(False))
    return df.select(*columns, (~blocked).alias("discharge_allowed"))


def pollution(
    df: DataFrame, ports: DataFrame, port_rules=PORT_RULES, country_rules=COUNTRY_RULES,
    land: DataFrame | None = None, piece_rows: int | None = None,
) -> DataFrame:
    """Per report: hours since the ship's previous one, allowed or not, kilograms, country and date.

    Only the columns the result needs, with the one emission rate of the current
    mode, travel through the per-ship shuffle; the spatial rules are map-side.
    """
    mode = F.col("operation_mode")
    rates = {name: F.col(f"emission_{name.lower()}") for name in MODES}
    slim = df.select(
        "id", "imo_number", "timestamp_collected", "latitude", "longitude", "operation_mode",
        rate_of_mode(mode, rates).alias("_rate"),
    )
    timed = hours_since_previous(slim, piece_rows=piece_rows)
    ruled = discharge_allowed(with_nearest_port(timed, ports), ports, port_rules, country_rules, land)
    country = F.when(F.col("nearest_nm") <= COUNTRY_RADIUS_NM, F.col("nearest_country")).otherwise(INTERNATIONAL)
    emitted = emission_for_interval(F.col("discharge_allowed"), mode, F.col("time_diff"), F.col("_rate"))
    return ruled.select(
        "id", "imo_number", "timestamp_collected", "operation_mode", "discharge_allowed", "time_diff",
        emitted.alias("pollution"), F.to_date("timestamp_collected").alias("date"), country.alias("country"),
    )


def daily_pollution(polluted: DataFrame) -> DataFrame:
    """Kilograms per day and country; reports without a time belong to no day."""
    return polluted.where(F.col("date").isNotNull()).groupBy("date", "country").agg(sum_or_zero(F.col("pollution")).alias("pollution"))


def pollution_by_country(polluted: DataFrame) -> DataFrame:
    return polluted.groupBy("country").agg(sum_or_zero(F.col("pollution")).alias("pollution"))


def pollution_summary(polluted: DataFrame) -> DataFrame:
    """Country totals with the overall hours and mean hourly rate repeated on every row."""
    by_country = polluted.groupBy("country").agg(
        sum_or_zero(F.col("pollution")).alias("total_pollution_kg"), sum_or_zero(F.col("time_diff")).alias("_hours")
    )
    # One row per country, so a window over all of them is small; the reports are read once.
    everywhere = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    hours, kilograms = F.sum("_hours").over(everywhere), F.sum("total_pollution_kg").over(everywhere)
    return by_country.select(
        "country", "total_pollution_kg", hours.alias("total_hours"),
        F.when(hours > 0, kilograms / hours).otherwise(F.lit(0.0)).alias("avg_hourly_rate_kg_per_hour"),
    )
