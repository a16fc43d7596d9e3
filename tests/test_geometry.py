import math
import random

import pytest
from pyspark.sql import functions as F

from stallwise.functions.geometry import MULTIPOLYGON, area, centroid, contains_point, geo_id, geojson, rings_of
from stallwise.functions.rd import request_point, wgs84_to_rd
from stallwise.operators.overlay import dissolve, dissolve_parts, dissolve_selection, make_valid
from stallwise.operators.spatial import containing_polygons, spots_at_points


def ring(*points):
    return [{"x": float(x), "y": float(y)} for x, y in points]


def box(x, y, w=1, h=1):
    return ring((x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y))


def shapes(spark, rows, names="k string"):
    return spark.createDataFrame(rows, f"{names}, geom {MULTIPOLYGON}")


DONUT = [[box(0, 0, 10, 10), box(2, 2, 4, 4)]]


def test_measures(spark):
    d = shapes(spark, [("donut", DONUT), ("two", [[box(120000, 485000, 3, 4)], [box(120010, 485000, 3, 4)]])])
    c = centroid(F.col("geom"))
    rows = {r.k: r for r in d.select("k", area(F.col("geom")).alias("a"), c.alias("c"), geo_id(c).alias("g")).collect()}
    assert rows["donut"].a == 84
    assert rows["donut"].c.x == pytest.approx((100 * 5 - 16 * 4) / 84)
    assert rows["two"].a == 24 and (rows["two"].c.x, rows["two"].c.y) == (120006.5, 485002)
    # Half-way goes to the even number.
    assert rows["two"].g == "120006485002"


def test_contains(spark):
    d = shapes(spark, [("donut", DONUT)])
    inside = lambda x, y: contains_point(rings_of(F.col("geom")), F.lit(float(x)), F.lit(float(y)))
    probes = {(1, 1): True, (3, 3): False, (2, 3): False, (0, 5): False, (10, 10): False, (9, 2): True, (11, 5): False, (1, 2): True}
    got = d.select(*[inside(x, y) for x, y in probes]).first()
    assert list(got) == list(probes.values())


def test_geojson(spark):
    d = shapes(spark, [("b", [[box(0, 0)]])])
    assert d.select(geojson(F.col("geom"))).first()[0] == (
        '{"type":"MultiPolygon","coordinates":[[[[0.0,0.0],[1.0,0.0],[1.0,1.0],[0.0,1.0],[0.0,0.0]]]]}'
    )


def test_control_points(spark):
    points = [
        (52.15517440, 5.38720621, 155000.0, 463000.0),
        (52.37453253, 4.88352559, 120700.723, 487525.502),
        (53.21938317, 6.56820053, 233883.131, 582065.167),
    ]
    d = spark.createDataFrame(points, "lat double, lon double, x double, y double")
    for r in d.select("x", "y", *[c.alias(n) for c, n in zip(wgs84_to_rd(F.col("lat"), F.col("lon")), ("px", "py"))]).collect():
        assert math.hypot(r.x - r.px, r.y - r.py) < 0.005


def test_request_point(spark):
    d = spark.createDataFrame([(None, None, 5.0, 6.0), (None, None, 0.0, 6.0), (52.1551744, 5.38720621, 1.0, 1.0), (52.0, None, None, 3.0)], "lat double, lon double, x double, y double")
    got = d.select(*request_point(F.col("lat"), F.col("lon"), F.col("x"), F.col("y"))).collect()
    assert tuple(got[0]) == (5, 6) and tuple(got[1])[0] is None and got[3][0] is None
    assert tuple(got[2]) == (155000, 463000)


def test_points_against_brute_force(spark):
    pick = random.Random(5)
    # Sizes from 1 to 2000 m, a third of them over one another.
    boxes = [(f"s{i}", pick.uniform(0, 500) if i % 3 else 40.0, pick.uniform(0, 500) if i % 3 else 40.0, 2 ** pick.uniform(0, 11), 2 ** pick.uniform(0, 6)) for i in range(120)]
    boxes.append(("s0copy", *boxes[0][1:]))
    points = [(i, pick.uniform(-10, 600), pick.uniform(-10, 600)) if i % 3 else (i, 41.0, 41.5) for i in range(400)]
    spots = shapes(spark, [(b[0], [[box(*b[1:])]]) for b in boxes], "id string")
    got = spots_at_points(spark.createDataFrame(points, "pid int, x double, y double"), spots, geom="geom")
    want = {}
    for pid, x, y in points:
        hit = [n for n, bx, by, w, h in boxes if bx < x < bx + w and by < y < by + h]
        if hit:
            want[pid] = min(hit)
    assert {r.pid: r.id for r in got.collect()} == want


def test_containing_polygons_gives_each_pair_once(spark):
    points = spark.createDataFrame([(1, 5.0, 5.0)], "pid int, x double, y double")
    polygons = shapes(spark, [("a", [[box(0, 0, 10, 10)]]), ("b", [[box(4, 4, 2, 2)]])])
    assert containing_polygons(points, polygons, "geom").count() == 2


UNIONS = [
    ([[box(0, 0, 2, 2)], [box(1, 1, 2, 2)]], [(7, 0)]),
    ([[box(0, 0)], [box(1, 0)]], [(2, 0)]),
    ([[box(0, 0)], [box(1, 1)]], [(1, 0), (1, 0)]),
    ([[box(0, 0, 10, 10)], [box(2, 2)]], [(100, 0)]),
    ([[box(0, 0, 10, 10), box(2, 2, 4, 4)]], [(84, 1)]),
    ([[box(0, 0, 10, 10), box(2, 2, 4, 4)], [box(3, 3, 1, 1)]], [(1, 0), (84, 1)]),
    ([[box(0, 0, 10, 10), box(2, 2, 4, 4)], [box(2, 2, 4, 4)]], [(100, 0)]),
    ([[box(0, 0, 3, 1)], [box(0, 2, 3, 1)], [box(0, 0, 1, 3)], [box(2, 0, 1, 3)]], [(8, 1)]),
    # The hole touches the shell in a point.
    ([[box(0, 0, 3, 1)], [box(0, 0, 1, 3)], [box(0, 2, 2, 1)], [box(2, 0, 1, 2)]], [(7, 1)]),
    # Over the borders of several tile sizes.
    ([[box(-5, -5, 300, 10)], [box(250, -5, 4000, 10)], [box(65530, 0, 12, 12)]], [(144, 0), (42550, 0)]),
    ([[ring((0, 0), (4, 0), (2, 3), (0, 0))], [ring((0, 2), (2, -1), (4, 2), (0, 2))]], [(8, 0)]),
]


def test_union(spark):
    """Area and number of holes of each part; all cases at once, each as its own group."""
    d = shapes(spark, [(str(i), [p]) for i, (polygons, _) in enumerate(UNIONS) for p in polygons])
    parts = dissolve_parts(d, ["k"], "geom").select("k", "polygon", area(F.array("polygon")).alias("a")).collect()
    for i, (_, want) in enumerate(UNIONS):
        assert sorted((round(r.a, 6), len(r.polygon) - 1) for r in parts if r.k == str(i)) == want, i


def test_union_of_many_boxes(spark):
    pick = random.Random(11)
    boxes = [(pick.choice("ab"), pick.randrange(40), pick.randrange(40), pick.randrange(1, 6), pick.randrange(1, 6)) for _ in range(260)]
    d = shapes(spark, [(b[0], [[box(*b[1:])]]) for b in boxes] + [(None, [[box(0, 0)]])])
    got = dissolve(d, ["k"], "geom")
    for r in got.select("k", "aantal", area(F.col("singleshape")).alias("a")).collect():
        mine = [b for b in boxes if b[0] == r.k]
        cells = {(x + i, y + j) for _, x, y, w, h in mine for i in range(w) for j in range(h)}
        assert (r.aantal, r.a) == (len(mine), len(cells))
    again = dissolve(got.select("k", F.col("singleshape").alias("geom")), ["k"], "geom")
    before, after = (f.select(F.sum(area(F.col("singleshape")))).first()[0] for f in (got, again))
    assert before == after


def test_union_of_turned_boxes(spark):
    """Slanted overlapping boxes: the union is covered by and covers what a fine grid says."""
    pick = random.Random(2)
    polygons = []
    for _ in range(25):
        cx, cy, a = pick.uniform(0, 30) + 121000, pick.uniform(0, 30) + 487000, pick.uniform(0, 3)
        corner = [(cx + 4 * math.cos(a + t), cy + 4 * math.sin(a + t)) for t in (0, 1.2, math.pi, math.pi + 1.2)]
        polygons.append([ring(*corner, corner[0])])
    d = shapes(spark, [("g", [p]) for p in polygons])
    union = dissolve(d, ["k"], "geom").select(F.col("singleshape").alias("u")).crossJoin(
        spark.createDataFrame([(pick.uniform(-5, 35) + 121000, pick.uniform(-5, 35) + 487000) for _ in range(400)], "x double, y double")
    )
    for r in union.select("x", "y", contains_point(rings_of(F.col("u")), F.col("x"), F.col("y")).alias("got")).collect():
        want = any(_inside(p[0], r.x, r.y) for p in polygons)
        assert r.got == want


def _inside(points, x, y):
    hit = False
    for p, q in zip(points, points[1:]):
        if (p["y"] > y) != (q["y"] > y) and x < p["x"] + (y - p["y"]) * (q["x"] - p["x"]) / (q["y"] - p["y"]):
            hit = not hit
    return hit


def test_selection(spark):
    spots = spark.createDataFrame(
        [("1", "a", [[box(0, 0)]]), ("2", "a", [[box(1, 0)]]), ("3", "b", [[box(5, 5)]])],
        f"id string, straatnaam string, geometrie {MULTIPOLYGON}",
    )
    size = lambda d: [(r.aantal, r.a) for r in d.select("aantal", area(F.col("singleshape")).alias("a")).collect()]
    assert size(dissolve_selection(spots, street="a", ids="3")) == [(2, 2)]
    assert size(dissolve_selection(spots, ids="1,3, 2")) == [(2, 2)]
    assert size(dissolve_selection(spots, street="none")) == []
    assert size(dissolve_selection(spots)) == []


REPAIRS = [
    ("bowtie", [[ring((0, 0), (2, 2), (2, 0), (0, 2), (0, 0))]], "MultiPolygon", 2, 2),
    ("bowtie with its node", [[ring((0, 0), (1, 1), (2, 2), (2, 0), (1, 1), (0, 2), (0, 0))]], "MultiPolygon", 2, 2),
    ("unclosed", [[ring((0, 0), (2, 0), (2, 2), (0, 2))]], "MultiPolygon", 4, 1),
    ("repeated", [[ring((0, 0), (0, 0), (2, 0), (2, 2), (2, 2), (0, 2), (0, 0))]], "MultiPolygon", 4, 1),
    ("line", [[ring((0, 0), (2, 0), (0, 0))]], "MultiLineString", None, None),
    ("flat", [[ring((0, 0), (2, 0), (4, 0), (0, 0))]], "MultiLineString", None, None),
    ("spike", [[ring((0, 0), (2, 0), (3, 0), (2, 0), (2, 2), (0, 2), (0, 0))]], "GeometryCollection", 4, 1),
    ("double", [[box(0, 0, 4, 4)], [box(2, 2, 4, 4)]], "MultiPolygon", 24, 2),
    ("wound twice", [[ring((0, 0), (6, 0), (6, 6), (2, 6), (2, 2), (4, 2), (4, 4), (0, 4), (0, 0))]], "MultiPolygon", 28, None),
    ("sound donut", DONUT, "MultiPolygon", 84, 1),
    ("shell in shell", [[box(0, 0, 10, 10)], [box(2, 2, 4, 4)]], "MultiPolygon", 84, 1),
    ("hole outside", [[box(0, 0, 4, 4), box(10, 0, 2, 2)]], "MultiPolygon", 20, 2),
    ("island", [[box(0, 0, 10, 10), box(2, 2, 4, 4)], [box(3, 3)]], "MultiPolygon", 85, 2),
    ("hole at the shell", [[box(0, 0, 4, 4), ring((0, 0), (2, 1), (1, 2), (0, 0))]], "MultiPolygon", 14.5, 1),
    ("none", None, None, None, None),
]


def test_make_valid(spark):
    d = shapes(spark, [(k, g) for k, g, *_ in REPAIRS])
    made = make_valid(d, "geom").select("k", "geometry_kind", area(F.col("geom")).alias("a"), F.size("geom").alias("n"))
    got = {r.k: r for r in made.collect()}
    assert len(got) == len(REPAIRS)
    for k, _, kind, size, count in REPAIRS:
        assert got[k].geometry_kind == kind, k
        if size is not None:
            assert got[k].a == pytest.approx(size), k
        if count is not None:
            assert got[k].n == count, k
