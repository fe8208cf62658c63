"""Scans, exact quantiles and proximity over groups of which one holds most rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import places, profile, scan


@pytest.fixture(autouse=True)
def ranges_stay(spark):
    """Spark joins small ranges into one; here they are to stay several."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def skewed(rng, n):
    return [rng.choice([None, 1, 2]) if rng.random() < 0.1 else 0 for _ in range(n)]


def test_scan_over_ranges(spark):
    rng = random.Random(15)
    rows = [(g, i, rng.choice([None, rng.randrange(-50, 50)])) for i, g in enumerate(skewed(rng, 3000))]
    df = spark.createDataFrame(rows, "g int, k0 int, v int")  # a user column named like an inner one
    got = scan.scan(scan.ranged(df, ["g"], ["k0"]), {"s": ("sum", F.col("row.v")), "lo": ("min", F.col("row.v")), "hi": ("max", F.col("row.v")), "on": ("least", F.col("row.v")), "p": ("prev", F.col("row.v")), "n": ("next", F.col("row.v"))})
    assert got.filter("k0 = 0").select("part").distinct().count() > 1  # the large group is in several ranges
    by = {}
    for g, i, v in rows:
        by.setdefault(g, []).append((i, v))
    least = lambda f, x: f((v for v in x if v is not None), default=None)
    want = {}
    for x in by.values():
        v = [b for _, b in x]
        for at, (i, _) in enumerate(x):
            want[i] = (sum(b or 0 for b in v[: at + 1]), least(min, v[: at + 1]), least(max, v[: at + 1]), least(min, v[at:]), v[at - 1] if at else None, v[at + 1] if at + 1 < len(v) else None)
    assert {r.row.k0: (r.s, r.lo, r.hi, r.on, r.p, r.n) for r in got.collect()} == want
    assert scan.scan(scan.ranged(df.limit(0), ["g"], ["k0"]), {"s": ("sum", F.col("row.v"))}).count() == 0


def test_gap_clusters_of_a_large_group(spark):
    rng = random.Random(16)
    rows = [(g, i, float(rng.randrange(12_000))) for i, g in enumerate(skewed(rng, 3000))]
    got = {r.r: r.cluster for r in places.gap_clusters(spark.createDataFrame(rows, "g int, r int, x double"), "g", F.col("x"), "r", 2.0).collect()}
    want = {}
    for g in {r[0] for r in rows}:
        line = sorted((x, r) for k, r, x in rows if k == g)
        run = np.cumsum(np.r_[True, np.diff([x for x, _ in line]) > 2])
        want |= {r: int(k) if (run == k).sum() > 1 else 0 for (_, r), k in zip(line, run, strict=True)}
    assert got == want


def test_unique_info(spark):
    rows = [(0, "a", 1), (0, "a", 2), (0, "b", 3), (None, "c", 4), (None, "c", 5), (1, None, 6), (2, "x", 7), (2, "y", 8)]
    df = spark.createDataFrame([(*r, True) for r in rows], "g int, info string, r int, has_duplicates boolean")
    got = {r.r: (r.has_duplicates, r.is_unique) for r in profile.unique_info(df, ["g"], ["info"], ["r"]).collect()}
    assert got == {1: (True, True), 2: (True, False), 3: (True, True), 4: (True, True), 5: (True, False), 6: (False, None), 7: (False, True), 8: (False, True)}


def test_exact_quantiles_by_selection(spark, monkeypatch):
    monkeypatch.setattr(profile, "ACCURACY", 40)
    rng = random.Random(17)
    groups = {"wide": [rng.gauss(0, 1e6) for _ in range(6001)], "hot": [7.0] * 1500 + [rng.random() for _ in range(300)], "two": [1.0, 4.0], "none": [None, None], None: [float(rng.randrange(9)) for _ in range(700)], "nulls": [None, 5.0, 6.0, None]}
    rows = [(g, x) for g, v in groups.items() for x in v]
    rng.shuffle(rows)
    got = {r.g: r for r in profile.quantile_summary(spark.createDataFrame(rows, "g string, x double"), ["g"], F.col("x"), small=100).collect()}
    assert got.keys() == groups.keys() and got["none"].median is None
    for g, v in groups.items():
        v = [x for x in v if x is not None]
        if v:
            assert np.allclose([got[g].min, got[g].q1, got[g].median, got[g].q3, got[g].max], np.quantile(v, [0, 0.25, 0.5, 0.75, 1]), rtol=1e-12)


def test_proximity_of_a_key_with_many_rows(spark):
    rng = np.random.default_rng(18)
    x = np.round(rng.uniform(0, 1000, 100_000), 2)
    boxed = rng.random(100_000) < 0.3
    df = spark.range(100_000).join(spark.createDataFrame([(i, float(v), bool(b)) for i, (v, b) in enumerate(zip(x, boxed, strict=True))], "i int, x double, b boolean"), F.col("id") == F.col("i")).withColumn("k", F.lit(None).cast("int"))
    small = spark.createDataFrame([(-1, 1.0, True, 5), (-2, 9.0, False, 5), (-3, 1.0, True, 6), (-4, None, True, 5), (-5, None, True, None)], "i int, x double, b boolean, k int")
    got = {r.i: r for r in profile.proximity_audit(df.drop("id").unionByName(small), "k", F.col("b"), "i", F.col("x"), 400.0).collect()}
    assert len(got) == boxed.sum() + 4
    y = x[~boxed]
    for i in np.flatnonzero(boxed)[::997]:
        far = np.abs(x[i] - y)[(y <= x[i] - 400) | (y >= x[i] + 400)]
        r = got[int(i)]
        assert (r.n_total, r.n_failed, r.near_any) == (len(y), len(far), len(far) < len(y))
        if len(far):
            assert np.allclose([r.failed_min, r.failed_mean, r.failed_max], [far.min(), far.mean(), far.max()], atol=1e-3)
    assert (got[-1].n_total, got[-1].n_failed, got[-1].near_any) == (1, 0, True) and got[-3].n_total == 0 and got[-3].near_any is None
    assert (got[-4].n_total, got[-4].near_any) == (0, None) and (got[-5].n_total, got[-5].near_any) == (0, None)
