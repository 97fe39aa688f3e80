"""Points in polygons, through cells that hold a bounded number of edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewake.operators import cells
from tidewake.operators.aggregate import retention_audit
from tidewake.session import materialize

# Edges of a cell. More than this many are only kept together where a cell of the finest level has them.
MOST_EDGES = 32

EDGE = ("x1", "y1", "x2", "y2")


def ring_edges(rings: DataFrame) -> DataFrame:
    """One row per polygon edge from ``(region_id, ring_id, vertices)``, closing each ring."""
    n = F.size("vertices")
    pairs = F.transform(
        F.col("vertices"),
        lambda v, i: F.struct(
            v["lon"].alias("x1"), v["lat"].alias("y1"),
            F.col("vertices")[(i + 1) % n]["lon"].alias("x2"), F.col("vertices")[(i + 1) % n]["lat"].alias("y2"),
        ),
    )
    return rings.select("region_id", F.explode(pairs).alias("e")).select("region_id", "e.*")


def _reference(level: int) -> tuple[Column, Column]:
    """The point of the row's cell whose place is kept: off the middle and off round coordinates.

    That of the one cell of level 0 lies far south of the pole, outside of everything.
    """
    west, south = cells.corner(level)
    width = cells.side(level)
    return west + width * 0.3819660112501051, south + width * 0.2360679774997897


def _turn(ax: Column, ay: Column, bx: Column, by: Column, px: Column, py: Column) -> Column:
    """Positive if P is to the left of the line from A to B."""
    return (bx - ax) * (py - ay) - (by - ay) * (px - ax)


def _crosses(e, px: Column, py: Column, rx: Column, ry: Column) -> Column:
    """Whether an edge crosses the segment from P to R.

    A vertex on the line through P and R counts as right of it for both of its
    edges, so a line through a vertex crosses as often as one beside it.
    """
    sides = (_turn(px, py, rx, ry, e["x1"], e["y1"]) > 0) != (_turn(px, py, rx, ry, e["x2"], e["y2"]) > 0)
    ends = (_turn(*[e[c] for c in EDGE], px, py) > 0) != (_turn(*[e[c] for c in EDGE], rx, ry) > 0)
    return sides & ends


def _touches(e, lon: Column, lat: Column) -> Column:
    return (
        (_turn(*[e[c] for c in EDGE], lon, lat) == 0)
        & lon.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
        & lat.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))
    )


def _reaches(e, level: int) -> Column:
    """Whether an edge reaches into the row's cell or comes within a hair of it."""
    west, south = cells.corner(level)
    half = cells.side(level) / 2
    x, y, room = west + half, south + half, half * (1 + 1e-6)
    dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
    boxes = (
        (F.least(e["x1"], e["x2"]) <= x + room) & (F.greatest(e["x1"], e["x2"]) >= x - room)
        & (F.least(e["y1"], e["y2"]) <= y + room) & (F.greatest(e["y1"], e["y2"]) >= y - room)
    )
    return boxes & (F.abs(dx * (y - e["y1"]) - dy * (x - e["x1"])) <= room * (F.abs(dx) + F.abs(dy)))


def _leaves(edges: DataFrame, places: DataFrame, level: int) -> DataFrame:
    """``_cx``, ``_cy`` and ``_leaf``: the reference point and, per region, its place and the edges."""
    listed = edges.groupBy(*cells.CELL, "region_id").agg(F.collect_list(F.struct(*EDGE)).alias("edges"))
    kept = places.select(*cells.CELL, "region_id", "inside").join(listed, [*cells.CELL, "region_id"], "left")
    none = F.array().cast(listed.schema["edges"].dataType)
    region = F.struct("inside", F.coalesce("edges", none).alias("edges"))
    grouped = kept.groupBy(*cells.CELL).agg(F.collect_list(region).alias("all"))
    # Inside one region is inside: the others need not be asked.
    whole = F.filter("all", lambda r: r["inside"] & (F.size(r["edges"]) == 0))
    x, y = _reference(level)
    regions = F.when(F.size(whole) > 0, F.slice(whole, 1, 1)).otherwise(F.col("all"))
    return grouped.select("_cx", "_cy", F.struct(x.alias("x"), y.alias("y"), regions.alias("regions")).alias("_leaf"))


def region_index(rings: DataFrame, most_edges: int = MOST_EDGES) -> dict[int, DataFrame]:
    """Leaf cells by level (see ``cells``), each with the edges that reach into it and the place of its reference point.

    Cells with more than ``most_edges`` edges are split. A child's reference point is
    inside where its parent's is, if the way between them crosses the region an even
    number of times, and else the other way round; only edges of the parent can lie on that way.
    A cell inside a region needs no edges; what has no leaf is outside.
    """
    edges = cells.root(ring_edges(rings)).select(*cells.CELL, "region_id", *EDGE)
    same = [*cells.CELL, "region_id"]
    places = edges.groupBy(*same).agg(F.count(F.lit(1)).alias("n")).withColumn("inside", F.lit(False))
    xs, ys = F.array("x1", "x2"), F.array("y1", "y2")
    count, *box = edges.agg(
        F.count(F.lit(1)), F.min(F.array_min(xs)), F.min(F.array_min(ys)), F.max(F.array_max(xs)), F.max(F.array_max(ys))).first()
    if count <= most_edges:
        return {0: _leaves(edges, places, 0)}
    # The first split goes right down to the cells that cover all edges.
    below, children = cells.covering(*box)
    edges, places, index, level = materialize(edges, "region-edges"), materialize(places, "region-places"), {}, 0
    while True:
        held = places.groupBy(*cells.CELL).agg(F.sum("n").alias("n"), F.max(F.col("inside") & (F.col("n") == 0)).alias("whole"))
        dense = held.where((F.col("n") > most_edges) & ~F.col("whole") & (below <= cells.FINEST))
        dense = materialize(dense.select(*cells.CELL), "region-dense")
        leaves = _leaves(edges.join(dense, cells.CELL, "left_anti"), places.join(dense, cells.CELL, "left_anti"), level)
        if level:
            index[level] = materialize(leaves, "region-leaves")
        if dense.isEmpty():
            return index
        x, y = _reference(level)
        parents = edges.join(dense, cells.CELL).join(places.drop("n"), same)
        spread = parents.withColumns({"_px": x, "_py": y}).withColumn("_child", F.explode(children))
        level, below, children = below, below + cells.STEP, cells.children()
        edge = {c: F.col(c) for c in EDGE}
        spread = spread.select("_child.*", "region_id", "inside", "_px", "_py", *EDGE)
        spread = spread.select("*", _reaches(edge, level).alias("reaches"), _crosses(edge, F.col("_px"), F.col("_py"), *_reference(level)).alias("crosses"))
        found = spread.groupBy(*same, "inside").agg(F.count_if("crosses").alias("crossed"), F.count_if("reaches").alias("n"))
        found = found.withColumn("inside", F.col("inside") != (F.col("crossed") % 2 == 1)).where("n > 0 OR inside").drop("crossed")
        places = materialize(found, "region-places")
        edges = materialize(spread.where("reaches").select(*same, *EDGE), "region-edges")


def _inside(leaf: Column, lon: Column, lat: Column) -> Column:
    """Whether the point is strictly inside any region of its leaf; points on an edge are outside."""
    def holds(r: Column) -> Column:
        crossed = F.aggregate(r["edges"], F.lit(False), lambda odd, e: odd != _crosses(e, lon, lat, leaf["x"], leaf["y"]))
        return (r["inside"] != crossed) & ~F.exists(r["edges"], lambda e: _touches(e, lon, lat))

    return F.coalesce(F.exists(leaf["regions"], holds), F.lit(False))


def within_region(
    df: DataFrame, rings: DataFrame, flag: str = "in_region", lat: str = "latitude", lon: str = "longitude",
    shifts: tuple[float, ...] = (0.0,), most_edges: int = MOST_EDGES,
) -> DataFrame:
    """Add ``flag``: the point is inside some polygon. Missing positions and points on an edge are not.

    With several ``shifts`` the point is moved by each of them in longitude and
    all moved points must be inside.
    """
    index, columns, tests = region_index(rings, most_edges), df.columns, []
    for k, shift in enumerate(shifts):
        at = F.col(lon) + F.lit(shift) if shift else F.col(lon)
        df = cells.look_up(df, index, at, F.col(lat), "_leaf").withColumn(f"_in_{k}", _inside(F.col("_leaf"), at, F.col(lat))).drop("_leaf")
        tests.append(F.col(f"_in_{k}"))
    combined = tests[0]
    for test in tests[1:]:
        combined = combined & test
    return df.select(*columns, combined.alias(flag))


def is_inland(df: DataFrame, land: DataFrame, flag: str = "inland", eps: float = 0.01) -> DataFrame:
    """Add ``flag``: there is land both ``eps`` degrees west and ``eps`` degrees east."""
    return within_region(df, land, flag, shifts=(-eps, eps))


def keep_region(df: DataFrame, rings: DataFrame, dry_run: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows kept inside the region, audit counts); with ``dry_run`` all rows are kept."""
    flagged = within_region(df, rings, "_kept")
    kept = flagged if dry_run else flagged.where("_kept")
    return kept.drop("_kept"), retention_audit(flagged, F.col("_kept"))
