"""Nearest sites, sites within a radius, density grids."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewake.functions import geo
from tidewake.operators import cells
from tidewake.session import materialize

# Up to this many sites every distance is an expression of its own. The limit
# keeps the generated method small enough (8,000 bytes) for the JVM to compile.
MAX_UNROLLED_SITES = 48

# Sites that a cell lists. More than this many are only listed together where a cell of the finest level has them.
MOST_SITES = 48

# The first level whose cells are listed: 16 degrees.
COARSEST = 2 * cells.STEP


# ---------------------------------------------------------------- nearest site

def nearest_site(
    df: DataFrame, sites: DataFrame, site_id: str = "port_id", payload: tuple[str, ...] = ("country",),
    prefix: str = "nearest_", lat: str = "latitude", lon: str = "longitude",
    max_unrolled: int = MAX_UNROLLED_SITES,
) -> DataFrame:
    """Add id, payload and distance (``<prefix>nm``) of the nearest site; ties go to the lowest id.

    Rows without a position get NULLs, sites without one are passed over. The
    inner product of unit vectors orders sites like great-circle distance and
    costs no trigonometry per site, so the haversine is computed only once per
    row. The products of at most ``max_unrolled`` sites become part of the
    projection; of longer lists a row looks up the few sites of its cell and
    takes the same products, so which way is taken can't change the result.
    """
    carried = [site_id, *payload, "latitude", "longitude"]
    sites = placed(sites)
    rows = _with_solid_vector(sites.select(*carried), "latitude", "longitude").limit(max_unrolled + 1).collect()
    if not rows:
        kinds = {f.name: f.dataType for f in sites.schema.fields}
        empty = [F.lit(None).cast(kinds[c]).alias(prefix + c) for c in (site_id, *payload)]
        return df.select("*", *empty, F.lit(None).cast("double").alias(f"{prefix}nm"))
    if len(rows) > max_unrolled:
        chosen = _nearest_by_cell(df, sites.select(*carried), site_id, lat, lon)
    else:
        chosen = _nearest_unrolled(df, sorted(rows, key=lambda r: r[site_id]), sites.select(*carried), lat, lon)
    site = F.col("_site")
    return chosen.select(
        *df.columns,
        *[site[c].alias(prefix + c) for c in (site_id, *payload)],
        geo.haversine_nm(F.col(lat), F.col(lon), site["latitude"], site["longitude"]).alias(f"{prefix}nm"),
    )


def placed(sites: DataFrame) -> DataFrame:
    """Sites that have a position."""
    return sites.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())


def _inner_products(rows: list) -> list[Column]:
    """Inner product of the row's unit vector (``_x``, ``_y``, ``_z``) with each site's."""
    def product(row) -> Column:
        return F.col("_x") * F.lit(row["_x"]) + F.col("_y") * F.lit(row["_y"]) + F.col("_z") * F.lit(row["_z"])

    return [product(row) for row in rows]


def _with_solid_vector(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """Add the unit vector with NaN for NULL, which keeps later arithmetic free of NULL checks."""
    vector = [F.coalesce(axis, F.lit(float("nan"))) for axis in geo.unit_vector(F.col(lat), F.col(lon))]
    return df.select("*", *[axis.alias(f"_{n}") for n, axis in zip("xyz", vector)])


def _nearest_unrolled(df: DataFrame, rows: list, sites: DataFrame, lat: str, lon: str) -> DataFrame:
    kinds = {f.name: f.dataType for f in sites.schema.fields}
    listed = F.array(*[
        F.struct(*[F.lit(row[c]).cast(kinds[c]).alias(c) for c in sites.columns]) for row in rows
    ])
    measured = _with_solid_vector(df, lat, lon).withColumn("_products", F.array(*_inner_products(rows)))
    first_best = F.array_position("_products", F.array_max("_products")).cast("int")
    known = F.col(lat).isNotNull() & F.col(lon).isNotNull()
    return measured.withColumn("_site", F.when(known, F.try_element_at(listed, first_best)))


def _radius(level: int) -> Column:
    """No point of the row's cell is farther from its centre than this, as a chord: half its height and half its greatest width."""
    _, south = cells.corner(level)
    half = cells.side(level) / 2
    nearest_equator = F.greatest(F.lit(0.0), F.abs(south + half) - half)
    return math.radians(half) * (1 + F.cos(F.radians(F.least(nearest_equator, F.lit(90.0)))))


def _dot(v: Column, *axes: Column) -> Column:
    return axes[0] * v["_x"] + axes[1] * v["_y"] + axes[2] * v["_z"]


def _could_be_nearest(listed: DataFrame, level: int) -> DataFrame:
    """Of rows (cell, ``_site``) those whose site may be the nearest to a point of the cell, with their number ``_n`` in it.

    With ``b`` the site that is nearest to the centre, site ``s`` is farther than ``b``
    everywhere in the cell if ``(s - b) * centre`` is below ``-|s - b| * radius``.
    """
    west, south = cells.corner(level)
    half = cells.side(level) / 2
    centre = geo.unit_vector(south + half, west + half)
    cell = Window.partitionBy(*cells.CELL)
    met = listed.withColumn("_best", F.max(F.struct(_dot(F.col("_site"), *centre).alias("near"), F.col("_site").alias("site"))).over(cell)["site"])
    gaps = [F.col("_site")[f"_{n}"] - F.col("_best")[f"_{n}"] for n in "xyz"]
    apart = F.sqrt(gaps[0] * gaps[0] + gaps[1] * gaps[1] + gaps[2] * gaps[2])
    nearer = gaps[0] * centre[0] + gaps[1] * centre[1] + gaps[2] * centre[2]
    # A little room for rounding.
    kept = met.where(nearer >= -apart * _radius(level) - 1e-12).select(*cells.CELL, "_site")
    return kept.withColumn("_n", F.count(F.lit(1)).over(cell))


def _on_globe(level: int) -> Column:
    west, south = cells.corner(level)
    width = cells.side(level)
    return (west <= 180) & (west + width > -180) & (south <= 90) & (south + width > -90)


def site_index(sites: DataFrame, site_id: str, most_sites: int = MOST_SITES) -> dict[int, DataFrame]:
    """Leaf cells by level (see ``cells``) with ``_sites``: all sites that are nearest to some point of the cell.

    Cells that list more than ``most_sites`` are split, and their sites dealt to
    the children by the same rule. Of sites in one place only the lowest id is kept.
    """
    vector = _with_solid_vector(sites, "latitude", "longitude")
    one = vector.groupBy("_x", "_y", "_z").agg(F.min_by(F.struct(*vector.columns), site_id).alias("_site")).select("_site")
    many = 1 << COARSEST
    axis = F.sequence(F.lit(0), F.lit(many - 1))
    placed_ = one.withColumn("_level", F.lit(COARSEST)).withColumn("_cx", F.explode(axis)).withColumn("_cy", F.explode(axis)).where(_on_globe(COARSEST))
    index, level = {}, COARSEST
    listed = materialize(_could_be_nearest(placed_.select(*cells.CELL, "_site"), level), "sites")
    while True:
        split = (F.col("_n") > most_sites) & (level + cells.STEP <= cells.FINEST)
        leaves = listed.where(~split).groupBy(*cells.CELL).agg(F.collect_list("_site").alias("_sites"))
        index[level] = materialize(leaves.select("_cx", "_cy", "_sites"), "sites-leaves")
        dense = listed.where(split)
        if dense.isEmpty():
            return index
        level += cells.STEP
        spread = dense.withColumn("_child", F.explode(cells.children())).select("_child.*", "_site").where(_on_globe(level))
        listed = materialize(_could_be_nearest(spread, level), "sites")


def _nearest_by_cell(df: DataFrame, sites: DataFrame, site_id: str, lat: str, lon: str, most_sites: int = MOST_SITES) -> DataFrame:
    """The nearest site among those of the point's cell, by the same inner products as in ``_nearest_unrolled``."""
    points = _with_solid_vector(df, lat, lon)
    # Positions beyond a pole or the date line, as the unit vector sees them.
    usual = F.col(lat).between(-90, 90) & F.col(lon).between(-180, 180)
    at_lat = F.when(usual, F.col(lat)).otherwise(F.degrees(F.asin("_z")))
    at_lon = F.when(usual, F.col(lon)).otherwise(F.degrees(F.atan2("_y", "_x")))
    found = cells.look_up(points, site_index(sites, site_id, most_sites), at_lon, at_lat, "_sites")

    def ranked(s: Column) -> Column:
        product = F.col("_x") * s["_x"] + F.col("_y") * s["_y"] + F.col("_z") * s["_z"]
        return F.struct((-product).alias("far"), s[site_id].alias("id"), s.alias("site"))

    known = F.col(lat).isNotNull() & F.col(lon).isNotNull()
    return found.withColumn("_site", F.when(known, F.array_min(F.transform("_sites", ranked))["site"]))


def any_site_within(
    df: DataFrame, sites: DataFrame, nm: float, flag: str, lat: str = "latitude", lon: str = "longitude",
    max_unrolled: int = MAX_UNROLLED_SITES,
) -> DataFrame:
    """Add ``flag``: whether any site lies at most ``nm`` nautical miles away (no position: false).

    That is whether the nearest one does: one haversine decides, whatever the
    number of sites. Sites without a position are passed over.
    """
    numbered = placed(sites).select("latitude", "longitude").distinct()
    numbered = numbered.withColumn("_number", F.hash("latitude", "longitude"))
    near = nearest_site(df, numbered, "_number", (), "_near_", lat, lon, max_unrolled)
    return near.select(*df.columns, F.coalesce(F.col("_near_nm") <= nm, F.lit(False)).alias(flag))


# --------------------------------------------------------------------- density

def heat_points(df: DataFrame) -> DataFrame:
    """Valid positions with weight 1."""
    lat, lon = F.col("latitude"), F.col("longitude")
    numeric = df.where(geo.valid_coordinates(lat, lon))
    return numeric.select(
        geo.as_number(lat).alias("latitude"), geo.as_number(lon).alias("longitude"), F.lit(1).alias("weight")
    )


def density_grid(df: DataFrame, cell: float = 0.25) -> DataFrame:
    """Weight per grid cell of the valid positions."""
    return (
        heat_points(df)
        .groupBy(geo.grid_cell(F.col("latitude"), cell).alias("lat_cell"),
                 geo.grid_cell(F.col("longitude"), cell).alias("lon_cell"))
        .agg(F.sum("weight").alias("weight"))
    )


def marker_points(latest: DataFrame) -> DataFrame:
    """Latest valid positions of flagged ships with what a map marker shows."""
    flagged = latest.where(F.col("has_scrubber") & geo.valid_coordinates(F.col("latitude"), F.col("longitude")))
    return flagged.select("imo_number", "latitude", "longitude", "name", "ship_type", "destination")
