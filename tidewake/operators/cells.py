"""Cells of a plane that refine where much lies, for lookups by position.

A cell of level ``l`` is a square of side ``ROOT_SIDE / 2**l`` degrees. An index holds
leaf cells of a few levels that do not overlap; whatever has to be compared with a point of
a leaf is one row of bounded length. Where a leaf would hold more it is split into 64, round by
round. A point is looked up once per level that has leaves, by an equi-join on its cell.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Side of the one cell of level 0, with the centre of the plane in its middle.
ROOT_SIDE = 1024.0

# Levels by which a cell is split at a time, and the finest level (about one metre).
STEP = 3
FINEST = 27

CELL = ["_level", "_cx", "_cy"]


def side(level: int) -> float:
    return ROOT_SIDE / 2**level


def cell_of(x: Column, y: Column, level: int) -> list[Column]:
    """Cell of a point, as columns ``_cx`` and ``_cy``."""
    return [F.floor((v + ROOT_SIDE / 2) / F.lit(side(level))).cast("int").alias(n) for v, n in ((x, "_cx"), (y, "_cy"))]


def corner(level: int) -> tuple[Column, Column]:
    """West and south border of the row's cell."""
    return F.col("_cx") * side(level) - ROOT_SIDE / 2, F.col("_cy") * side(level) - ROOT_SIDE / 2


def root(df: DataFrame) -> DataFrame:
    """All rows in the cell of level 0."""
    return df.withColumns({c: F.lit(0) for c in CELL})


def children() -> Column:
    """The cells that the row's cell is split into, as an array of structs of ``CELL``."""
    many = 1 << STEP

    def child(k: Column) -> Column:
        return F.struct(
            (F.col("_level") + STEP).alias("_level"), (F.col("_cx") * many + k % many).cast("int").alias("_cx"),
            (F.col("_cy") * many + F.floor(k / many)).cast("int").alias("_cy"))

    return F.transform(F.sequence(F.lit(0), F.lit(many * many - 1)), child)


def covering(west: float, south: float, east: float, north: float) -> tuple[int, Column]:
    """The finest level at which the box takes no more cells than a split makes, and these cells as an array."""
    def spans(level: int) -> list[range]:
        return [range(*(math.floor((v + ROOT_SIDE / 2) / side(level)) + k for v, k in ((a, 0), (b, 1)))) for a, b in ((west, east), (south, north))]

    level = max(n for n in range(FINEST + 1) if math.prod(map(len, spans(n))) <= 1 << 2 * STEP)
    xs, ys = spans(level)
    named = [[F.lit(v).alias(n) for v, n in zip((level, x, y), CELL)] for x in xs for y in ys]
    return level, F.array(*[F.struct(*cell) for cell in named])


def look_up(df: DataFrame, index: dict[int, DataFrame], x: Column, y: Column, value: str) -> DataFrame:
    """Add ``value`` of the leaf that holds the point; NULL where none does.

    ``index`` has the leaves of each level with columns ``_cx``, ``_cy`` and
    ``value``. A level 0 index is a single row, which is broadcast; others are
    stored tables, whose measured size decides how they are joined.
    """
    columns, found = df.columns, []
    for level, leaves in sorted(index.items()):
        name = f"_{value}_{level}"
        side_table = leaves.select(F.col("_cx").alias("_jx"), F.col("_cy").alias("_jy"), F.col(value).alias(name))
        at_x, at_y = cell_of(x, y, level)
        keyed = df.withColumns({"_px": at_x, "_py": at_y})
        side_table = F.broadcast(side_table) if level == 0 else side_table
        df = keyed.join(side_table, (F.col("_px") == F.col("_jx")) & (F.col("_py") == F.col("_jy")), "left").drop("_px", "_py", "_jx", "_jy")
        found.append(name)
    return df.select(*columns, F.coalesce(*found).alias(value))
