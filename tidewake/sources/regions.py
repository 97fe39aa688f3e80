"""Polygon sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_SHAPE = "geometry: struct<type: string, coordinates: string>"


def read_rings(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """(region_id, ring_id, vertices) from GeoJSON files of Polygon and MultiPolygon features.

    A region is a feature of a file; holes are rings of their region and are cut
    out by the even-odd rule. A feature collection is read whole by one task; with
    ``lines`` files have one feature per line instead and are read by as many tasks as their size asks for.
    """
    polygon = "array<array<array<double>>>"
    if lines:
        named = spark.read.schema(_SHAPE.replace(": ", " ", 1)).json(path).select(
            F.concat_ws("#", F.input_file_name(), F.monotonically_increasing_id()).alias("region_id"), "geometry")
    else:
        collections = spark.read.schema(f"features array<struct<{_SHAPE}>>").json(path, multiLine=True)
        named = collections.select(F.input_file_name().alias("file"), F.posexplode("features").alias("feature", "f")).select(
            F.concat_ws("#", "file", "feature").alias("region_id"), "f.geometry")
    shape = F.col("geometry.coordinates")
    polygons = F.when(F.col("geometry.type") == "MultiPolygon", F.from_json(shape, f"array<{polygon}>")).otherwise(F.array(F.from_json(shape, polygon)))
    rings = named.where(shape.isNotNull()).select("region_id", F.posexplode(F.flatten(polygons)).alias("ring_id", "r"))
    vertices = F.transform("r", lambda p: F.struct(p[0].alias("lon"), p[1].alias("lat")))
    return rings.select("region_id", "ring_id", vertices.alias("vertices"))


def rings_from_vertices(vertices: DataFrame, region: str = "region_id", seq: str = "seq") -> DataFrame:
    """The same from one row per vertex, one ring per region."""
    points = F.sort_array(F.collect_list(F.struct(F.col(seq).alias("seq"), "lon", "lat")))
    return vertices.groupBy(F.col(region).alias("region_id")).agg(
        F.lit(0).alias("ring_id"), F.transform(points, lambda p: F.struct(p["lon"].alias("lon"), p["lat"].alias("lat")))
        .alias("vertices"),
    )
