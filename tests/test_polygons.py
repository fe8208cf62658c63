"""Polygons' covers against the ray rule over all edges."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import polygons


def ring(points):
    return list(zip(points, points[1:] + points[:1], strict=True))


def holds(edges, x, y):
    odd = False
    for (x1, y1), (x2, y2) in edges:
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            odd = not odd
    return odd


def star(rng, n, cx, cy, r):
    at = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
    return [(cx + r * rng.uniform(0.5, 1) * math.cos(a), cy + r * rng.uniform(0.5, 1) * math.sin(a)) for a in at]


def test_polygons_of_all_sizes(spark, monkeypatch):
    monkeypatch.setattr(polygons, "EDGES", 4)
    rng = random.Random(12)
    shapes = {1: [(0, 0), (4, 0), (4, 4), (0, 4)], 2: [(4, 0), (8, 0), (8, 4), (4, 4)], 3: star(rng, 120, 5, 5, 5), 4: star(rng, 7, 1, 1, 0.01), 5: star(rng, 40, -3, 2, 1), 6: [(0, 0), (3, 3), (6, 0), (6, 6), (0, 6)]}
    rings = {k: ring([tuple(map(float, p)) for p in v]) for k, v in shapes.items()}
    rings[3] += ring([(4.9, 4.9), (5.1, 4.9), (5.1, 5.1), (4.9, 5.1)])  # a hole
    rows = [(k, *a, *b) for k, e in rings.items() for a, b in e]
    points = [(rng.uniform(-5, 11), rng.uniform(-5, 11)) for _ in range(400)] + [(float(x), float(y)) for x in range(-1, 9) for y in range(-1, 8)] + [(1 + rng.uniform(-0.02, 0.02), 1 + rng.uniform(-0.02, 0.02)) for _ in range(50)]
    points += [(None, 1.0), (1.0, None), (1e300, 1.0), (float("nan"), 1.0)]
    df = spark.createDataFrame([(i, *p, "own") for i, p in enumerate(points)], "id int, x double, y double, row string")
    edges = spark.createDataFrame(rows, "polygon int, x1 double, y1 double, x2 double, y2 double")
    got = {}
    for r in polygons.in_polygons(df, "x", "y", edges).collect():
        got.setdefault(r.id, []).append(r.polygon)
        assert r.row == "own"
    for i, (x, y) in enumerate(points):
        want = [k for k, e in rings.items() if x is not None and y is not None and holds(e, x, y)]
        assert sorted(got[i], key=str) == (want or [None]), (i, x, y)
    assert polygons.in_polygons(df, "x", "y", edges.limit(0)).filter("polygon is null").count() == len(points)
    assert polygons.in_polygons(df.limit(0), "x", "y", edges).count() == 0


@pytest.fixture(scope="module")
def coast(spark):
    rng = random.Random(13)
    n = 100_000
    points = [((10 + rng.uniform(-0.01, 0.01)) * math.cos(2 * math.pi * k / n), (10 + rng.uniform(-0.01, 0.01)) * math.sin(2 * math.pi * k / n)) for k in range(n)]
    return ring(points)


def test_long_border(spark, coast):
    edges = spark.createDataFrame([(1, *a, *b) for a, b in coast], "polygon int, x1 double, y1 double, x2 double, y2 double")
    cover, _ = polygons.polygon_cells(edges)
    most, cells, inner = cover.agg(F.max(F.size("edges")), F.count(F.lit(1)), F.count_if(F.col("edges").isNull())).first()
    assert most <= polygons.EDGES and inner > 50 and cells < 60_000
    rng = random.Random(14)
    points = [(i, rng.uniform(-10.1, 10.1), rng.uniform(-10.1, 10.1)) for i in range(60)]
    points += [(100 + i, 10 * math.cos(a), 10 * math.sin(a)) for i in range(40) for a in (rng.uniform(0, 7),)]
    df = spark.createDataFrame(points, "id int, x double, y double")
    got = {r.id: r.polygon == 1 for r in polygons.in_polygons(df, "x", "y", edges).collect()}
    assert got == {i: holds(coast, x, y) for i, x, y in points}
