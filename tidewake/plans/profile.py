"""Exploratory profile of recent positions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewake.functions.geo import STUDY_BOX, within_bbox
from tidewake.operators.lookups import category_of_type
from tidewake.operators.temporal import first_per_key
from tidewake.plans.destinations import profile_destinations

# What stands for missing fields.
FILL = {
    "destination": "Unknown", "sog": 0, "cog": 0, "navigational_status": "Unknown", "rate_of_turn": 0,
    "port_name": "Unknown", "country": "Unknown", "latitude_y": 0, "longitude_y": 0,
}


def fill_defaults(df: DataFrame, defaults: dict[str, object] = FILL) -> DataFrame:
    """Fill NULLs per column; defaults of columns that do not exist are ignored."""
    present = {c: v for c, v in defaults.items() if c in df.columns}
    return df.fillna(present) if present else df


def merge_ship_and_port(positions: DataFrame, ships: DataFrame, ports: DataFrame) -> DataFrame:
    """Positions with ship columns and, where the destination names a port, the port's."""
    ship_side = ships.select("imo_number", "name", "ship_type", "length", "width")
    port_side = ports.select("port_id", "port_name", "country")
    with_ship = positions.join(ship_side, "imo_number", "left")
    return with_ship.join(port_side, with_ship["destination"] == port_side["port_name"], "left")


def study_area(df: DataFrame) -> DataFrame:
    return df.where(within_bbox(F.col("latitude"), F.col("longitude"), STUDY_BOX))


def one_row_per_ship(merged: DataFrame, types: DataFrame, order: tuple[str, ...] = ("timestamp_collected", "id")) -> DataFrame:
    """First row of each ship with its type category and profile destination."""
    ships = first_per_key(merged, ["imo_number"], list(order))
    return profile_destinations(category_of_type(ships, types))
