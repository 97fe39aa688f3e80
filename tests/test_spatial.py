"""Regions and nearest sites against brute force."""

import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewake.functions import geo
from tidewake.functions.geo import EARTH_RADIUS_NM
from tidewake.operators import cells, regions, spatial
from tidewake.operators.regions import is_inland, keep_region, within_region
from tidewake.operators.spatial import any_site_within, nearest_site
from tidewake.plans.pollution import PortRule, CountryRule, discharge_allowed
from tidewake.sources.regions import read_rings


def distance(lat1, lon1, lat2, lon2):
    p1, p2 = math.radians(lat1), math.radians(lat2)
    a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * EARTH_RADIUS_NM * math.asin(math.sqrt(min(1.0, a)))


def sites_frame(spark, sites):
    return spark.createDataFrame(
        [(i, f"P{i}", f"C{i % 5}", la, lo) for i, (la, lo) in enumerate(sites)],
        "port_id int, port_name string, country string, latitude double, longitude double",
    )


def points_frame(spark, points):
    return spark.createDataFrame([(i, la, lo) for i, (la, lo) in enumerate(points)], "id long, latitude double, longitude double")


@pytest.mark.parametrize("count", [1, 2, 30, 400])
def test_nearest_site_anywhere(spark, count):
    rng = random.Random(count)
    sites = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(count)]
    points = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(300)]
    points += [(89.9, 10.0), (-89.9, 0.0), (0.0, 180.0), (0.0, -180.0), (90.0, 0.0), sites[0], (None, 1.0), (1.0, None)]
    near = nearest_site(points_frame(spark, points), sites_frame(spark, sites)).orderBy("id").collect()
    for row, (la, lo) in zip(near, points):
        if la is None or lo is None:
            assert row["nearest_port_id"] is None and row["nearest_nm"] is None
            continue
        best = min(distance(la, lo, *s) for s in sites)
        assert abs(row["nearest_nm"] - best) < 1e-6
        assert abs(distance(la, lo, *sites[row["nearest_port_id"]]) - best) < 1e-6
        assert row["nearest_country"] == f"C{row['nearest_port_id'] % 5}"


@pytest.mark.parametrize("unrolled", [48, 0])
def test_ties_and_empty_lists(spark, unrolled):
    points = points_frame(spark, [(50.0, 1.0), (None, None)])
    twins = sites_frame(spark, [(51.0, 1.0), (50.5, 1.0), (50.5, 1.0)])
    assert [r["nearest_port_id"] for r in nearest_site(points, twins, max_unrolled=unrolled).orderBy("id").collect()] == [1, None]
    none = twins.where("port_id > 99")
    assert [r["nearest_nm"] for r in nearest_site(points, none, max_unrolled=unrolled).collect()] == [None, None]
    assert [r["f"] for r in any_site_within(points, none, 3, "f", max_unrolled=unrolled).collect()] == [False, False]


@pytest.mark.parametrize("unrolled", [48, 1])
def test_radius(spark, unrolled):
    degree = EARTH_RADIUS_NM * math.pi / 180
    points = points_frame(spark, [(50 + nm / degree, 1.0) for nm in (0, 2.999999, 3.000001, 12)] + [(None, 1.0)])
    sites = sites_frame(spark, [(50.0, 1.0), (10.0, 1.0)])
    rows = any_site_within(points, sites, 3, "near", max_unrolled=unrolled).orderBy("id").collect()
    assert [r["near"] for r in rows] == [True, True, False, False, False]


SQUARE = [[0, 50], [4, 50], [4, 54], [0, 54], [0, 50]]
HOLE = [[1, 51], [2, 51], [2, 52], [1, 52], [1, 51]]
DIAMOND = [[10, 50], [12, 52], [10, 54], [8, 52], [10, 50]]


@pytest.fixture
def rings(spark, tmp_path):
    features = [
        {"type": "Feature", "properties": {"a": 1}, "geometry": {"type": "Polygon", "coordinates": [SQUARE, HOLE]}},
        {"type": "Feature", "properties": {}, "geometry": {"type": "MultiPolygon", "coordinates": [[DIAMOND]]}},
    ]
    (tmp_path / "region.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    return read_rings(spark, str(tmp_path / "region.geojson"))


def test_features_by_line(spark, rings, tmp_path):
    """One feature a line gives the same rings, from several tasks."""
    shapes = [("Polygon", [SQUARE, HOLE]), ("MultiPolygon", [[DIAMOND]])] + [("Polygon", [[[k, 0], [k + 1, 0], [k, 1]]]) for k in range(300)]
    lines = [json.dumps({"type": "Feature", "geometry": {"type": kind, "coordinates": shape}}) for kind, shape in shapes]
    (tmp_path / "features.geojsonl").write_text("\n".join([*lines, json.dumps({"type": "Feature", "geometry": None})]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        found = read_rings(spark, str(tmp_path / "features.geojsonl"), lines=True)
        assert found.rdd.getNumPartitions() > 2
        assert found.select("region_id").distinct().count() == len(shapes) and found.count() == len(shapes) + 1
        first = found.where(F.size("vertices") == 5).select("ring_id", "vertices").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(map(tuple, first)) == sorted(map(tuple, rings.select("ring_id", "vertices").collect()))


def test_polygons(spark, rings):
    cases = {
        (53.0, 3.0): True, (51.5, 1.5): False, (52.0, 9.0): True, (50.5, 9.0): False, (40.0, 3.0): False, (53.0, 30.0): False,
        # On edges and corners, of the hole and of the slanted side too.
        (50.0, 2.0): False, (52.0, 4.0): False, (54.0, 4.0): False, (51.0, 1.5): False, (51.0, 9.0): False, (52.0, 8.0): False,
        (52.0, 12.0): False, (50.0, 10.0): False, (52.0, 2.5): True, (None, 3.0): False,
    }
    flagged = within_region(points_frame(spark, list(cases)), rings).orderBy("id").collect()
    assert [r["in_region"] for r in flagged] == list(cases.values())


def test_inland_needs_land_on_both_sides(spark, rings):
    points = points_frame(spark, [(53.0, 3.0), (53.0, 3.995), (53.0, 0.005), (51.5, 0.995), (51.5, 1.0), (None, None)])
    rows = is_inland(points, rings).orderBy("id").collect()
    assert [r["inland"] for r in rows] == [True, False, False, False, False, False]


def test_random_points_against_half_planes(spark, rings):
    rng = random.Random(5)
    points = [(rng.uniform(49, 55), rng.uniform(-1, 13)) for _ in range(2000)]

    def inside(la, lo):
        square = 0 < lo < 4 and 50 < la < 54 and not (1 <= lo <= 2 and 51 <= la <= 52)
        return square or abs(lo - 10) + abs(la - 52) < 2

    rows = within_region(points_frame(spark, points), rings).orderBy("id").collect()
    assert [r["in_region"] for r in rows] == [inside(*p) for p in points]


def test_keep_region_reports(spark, rings):
    points = points_frame(spark, [(53.0, 3.0), (40.0, 3.0), (None, None), (52.0, 9.0)])
    kept, audit = keep_region(points, rings)
    assert sorted(r["id"] for r in kept.collect()) == [0, 3]
    assert audit.first().asDict() == {"total": 4, "kept": 2, "deleted": 2, "kept_percent": 50.0, "deleted_percent": 50.0}
    assert keep_region(points, rings, dry_run=True)[0].count() == 4
    assert keep_region(points.limit(0), rings)[1].first()["kept_percent"] == 0.0


def test_discharge_rules(spark, rings):
    ports = spark.createDataFrame(
        [(0, "Berthport", "aa", 50.0, 20.0), (1, "PORTPORT", "BB", 55.0, 20.0), (2, "DISTANT", "CC", 60.0, 20.0),
         (3, "INNER", "DD", 53.0, 3.0)],
        "port_id int, port_name string, country string, latitude double, longitude double",
    )
    rules = (PortRule("BERTHPORT", "berth"), PortRule("PORTPORT", "port"))
    countries = (CountryRule("CC", "distance", 3), CountryRule("DD", "inland_port"))
    cases = [
        (50.0, 20.0, "Berth", False), (50.0, 20.0, "Anchor", True), (50.0, 20.0, None, True),
        (55.0, 20.0, "Anchor", False), (55.0, 20.0, "Berth", False), (55.0, 20.0, "Cruise", True),
        (60.0, 20.0, "Cruise", False), (60.2, 20.0, "Cruise", True),
        (53.0, 3.0, "Cruise", False), (53.0, 3.995, "Cruise", True), (None, None, "Berth", True),
    ]
    df = spark.createDataFrame(
        [(i, *c[:3]) for i, c in enumerate(cases)], "id long, latitude double, longitude double, operation_mode string"
    )
    rows = discharge_allowed(df, ports, rules, countries, rings).orderBy("id").collect()
    assert [r["discharge_allowed"] for r in rows] == [c[3] for c in cases]


@pytest.mark.parametrize("unrolled", [0, 48])
@pytest.mark.parametrize("nm", [3, 12])
def test_border_of_a_radius(spark, unrolled, nm):
    """The haversine decides, for any number of sites: at the distance itself a point is within, below it not."""
    sites = spark.createDataFrame([(1, "X", 52.0, 4.0), (2, "X", None, 4.0), (3, "X", 40.0, 4.0)], "port_id int, country string, latitude double, longitude double")
    points = spark.range(40).select("id", (52.0 + nm / 60 + (F.col("id") - 20) * 1e-9).alias("latitude"), F.lit(4.0).alias("longitude"))
    away = geo.haversine_nm(F.col("latitude"), F.col("longitude"), F.lit(52.0), F.lit(4.0))
    rows = any_site_within(points, sites, nm, "near", max_unrolled=unrolled).withColumn("inside", away <= nm).collect()
    assert all(r["near"] == r["inside"] for r in rows) and len(rows) == 40
    exact = points.select(away).first()[0]
    at = any_site_within(points.where("id = 0"), sites, exact, "near", max_unrolled=unrolled).first()
    assert at["near"]


def nearest_by_hand(points, sites):
    """Largest inner product of unit vectors, ties to the lowest id."""
    def vector(la, lo):
        la, lo = np.radians(la), np.radians(lo)
        return np.stack([np.cos(la) * np.cos(lo), np.cos(la) * np.sin(lo), np.sin(la)], axis=-1)

    at, to = vector(*np.array(points).T), vector(*np.array(sites).T)
    return [(int((to @ p).argmax()), to @ p) for p in at]


def spots(rng, kind, n):
    if kind == "cluster":
        return [(52 + rng.random() * 0.2, 4 + rng.random() * 0.2) for _ in range(n)]
    if kind == "pole":
        return [(90 - rng.random(), rng.uniform(-180, 180)) for _ in range(n)]
    if kind == "date line":
        return [(rng.uniform(-5, 5), (179 + rng.random() * 2 + 180) % 360 - 180) for _ in range(n)]
    return [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(n)]


@pytest.mark.parametrize("kind", ["cluster", "pole", "date line", "globe"])
def test_many_sites(spark, kind):
    """Sites close together, around a pole, across the date line and everywhere: near and far points find their own nearest one."""
    rng = random.Random(8)
    sites = spots(rng, kind, 400)
    points = spots(rng, kind, 150) + spots(rng, "globe", 150) + sites[:20] + [(90.0, 0.0), (-90.0, 5.0), (0.0, 180.0), (0.0, -180.0)]
    found = nearest_site(points_frame(spark, points), sites_frame(spark, sites)).orderBy("id").collect()
    for row, (best, products) in zip(found, nearest_by_hand(points, sites)):
        assert row["nearest_port_id"] == best or products[row["nearest_port_id"]] > products[best] - 1e-15


def test_lists_stay_short(spark):
    """2,000 sites in one place: no cell lists many, whatever the number of sites."""
    sites = sites_frame(spark, spots(random.Random(9), "cluster", 2000))
    index = spatial.site_index(sites, "port_id")
    longest = max(leaves.agg(F.max(F.size("_sites"))).first()[0] for leaves in index.values())
    assert longest <= spatial.MOST_SITES
    assert sum(leaves.count() for leaves in index.values()) < 300_000


@pytest.mark.parametrize("unrolled", [48, 0])
def test_both_ways_take_the_same_site(spark, unrolled):
    """Equal products go to the lowest id, in unrolled lists and by cell."""
    sites = sites_frame(spark, [(10.0, 20.0), (10.0, -20.0), (10.0, 20.0), (10.0, 340.0), (-10.0, 180.0), (-10.0, -180.0)])
    points = points_frame(spark, [(10.0, 0.0), (10.0, 20.0), (-10.0, 179.0), (10.0, -21.0), (95.0, 10.0), (10.0, 725.0)])
    found = nearest_site(points, sites, max_unrolled=unrolled).orderBy("id").collect()
    assert [r["nearest_port_id"] for r in found] == [0, 0, 4, 1, 1, 0]


def coast(n):
    """A star-shaped coast line of ``n`` edges around (52, 4), and its radius by angle."""
    angle = np.linspace(0, 2 * math.pi, n, endpoint=False)

    def radius(a):
        return 3 + np.sin(5 * a) + 0.3 * np.sin(47 * a) + 0.02 * np.sin(97 * a)

    return angle, radius


def coast_rings(spark, n):
    angle, radius = coast(n)
    lon, lat = 4 + radius(angle) * np.cos(angle), 52 + radius(angle) * np.sin(angle)
    return spark.createDataFrame([("coast", 0, [{"lon": float(x), "lat": float(y)} for x, y in zip(lon, lat)])],
                                 "region_id string, ring_id int, vertices array<struct<lon double, lat double>>")


def test_long_coast(spark):
    """A coast of 4,000 edges: no leaf holds many of them, and points near and far from it are told apart."""
    n = 4_000
    rings = coast_rings(spark, n)
    index = regions.region_index(rings)
    assert set(index) - {0} and all(level % cells.STEP == 0 for level in index)
    most = max(leaves.agg(F.max(F.aggregate("_leaf.regions", F.lit(0), lambda k, r: k + F.size(r["edges"])))).first()[0] for leaves in index.values())
    assert most <= regions.MOST_EDGES
    rng = np.random.default_rng(5)
    a = rng.uniform(0, 2 * math.pi, 2000)
    _, radius = coast(n)
    r = np.where(rng.random(2000) < 0.5, rng.uniform(0, 6, 2000), radius(a) + rng.choice([-1e-3, 1e-3], 2000))
    points = [(52 + float(x * math.sin(t)), 4 + float(x * math.cos(t))) for x, t in zip(r, a)]
    rows = within_region(points_frame(spark, points), rings).orderBy("id").collect()
    assert [row["in_region"] for row in rows] == (r < radius(a)).tolist()


@pytest.mark.parametrize("most_edges", [32, 2])
def test_overlapping_regions_in_small_cells(spark, rings, most_edges):
    """The union of all regions, whether cells are split or not."""
    rng = random.Random(6)
    more = [(f"box{k}", 0, [{"lon": float(x), "lat": y} for x, y in ((k, 48.0), (k + 1.5, 48.0), (k + 1.5, 55.0), (k, 55.0))]) for k in range(5, 20)]
    every = rings.select("region_id", "ring_id", "vertices").unionByName(spark.createDataFrame(more, rings.schema))
    points = [(rng.uniform(47, 56), rng.uniform(-1, 23)) for _ in range(800)] + [(52.0, float(k)) for k in range(23)]

    def inside(la, lo):
        square = 0 < lo < 4 and 50 < la < 54 and not (1 <= lo <= 2 and 51 <= la <= 52)
        return square or abs(lo - 10) + abs(la - 52) < 2 or (48 < la < 55 and any(k < lo < k + 1.5 for k in range(5, 20)))

    rows = within_region(points_frame(spark, points), every, most_edges=most_edges).orderBy("id").collect()
    assert [r["in_region"] for r in rows] == [inside(*p) for p in points]
