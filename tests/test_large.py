"""What grows with the input: nothing of it goes through the driver or in one task."""

import random
from decimal import Decimal

from pyspark.sql import functions as F

from tidemark.operators import nearest, places, survivors
from tidemark.operators.components import labelled
from tidemark.sources import ranges


def test_tables_of_rows_are_not_broadcast(spark):
    rows = spark.range(300).select(F.col("id").alias("r"), (F.col("id") % 40).alias("k"), (F.col("id") % 7 * 0.5).alias("x"), (F.col("id") % 3).cast("int").alias("f"))
    x = F.col("x")
    made = [
        survivors.introduced(rows, "k", {"f": F.col("f")}),
        places.density_clusters(rows, "k", "r", x, x, 0.75),
        survivors.compressed(rows.withColumns({"cluster": x, "is_noise": F.lit(False), "decision": F.lit("Keep"), "lender": F.col("r")}), "k", "r", {"f": "f"}),
    ]
    for df in made:
        assert df.count() == 300 and "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()


def test_nearest_ties_of_tenths_go_to_the_least_row(spark, monkeypatch):
    spots = [(1, 1.0, 5), (2, 1.3, 6), (3, 0.5, 5), (4, 1.3, 4), *[(9 + i, 50.0 + i, i % 7) for i in range(150)]]  # 2, 3 and 4 are 0.5 from 1
    df = spark.createDataFrame(spots, "r int, x double, i int").withColumn("g", F.lit(1))
    y = (F.col("i") * F.lit(Decimal("0.4"))).cast("decimal(3, 1)")
    for small in (10_000, 10):
        monkeypatch.setattr(nearest, "SMALL_GROUP", small)
        got = nearest.nearest_offers(df.filter("r = 1"), df.filter("r <> 1"), "g", "r", F.col("x"), y).first()
        assert (got.offer, got.distance) == (2, 0.5)


def test_ranges_are_listed_once(spark, tmp_path, monkeypatch):
    listed = []
    real = ranges._listed
    monkeypatch.setattr(ranges, "_listed", lambda s, p, folders, k: listed.extend(folders) or real(s, p, folders, k))
    monkeypatch.setattr(ranges, "AT_ONCE", 2)
    monkeypatch.setattr(ranges, "JOBS", 3)
    df = spark.range(1, 101).select(F.col("id").alias("n")).filter("n not between 41 and 50")
    assert ranges.write_ranges(df, f"{tmp_path}/out", "n", 10) == 10
    assert len(listed) == len(set(listed)) == 9
    ledger = ranges.range_ledger(spark, f"{tmp_path}/out").collect()
    assert {r.first: r.n_rows for r in ledger} == {i: 10 * (i != 41) for i in range(1, 101, 10)}
    assert ranges._entries(spark, f"{tmp_path}/out").agg(F.max("step")).first()[0] == 6  # three jobs
    assert all(len([f for f in p.iterdir() if f.name.startswith("part-")]) == 1 for p in (tmp_path / "out").glob("rows=*"))


def test_points_of_small_groups_are_not_copied(spark, monkeypatch):
    monkeypatch.setattr(places, "SMALL_GROUP", 20)
    rng = random.Random(5)
    rows = [(g, i, rng.randrange(30) * 0.3, rng.randrange(30) * 0.3) for i, g in enumerate([None, *range(1, 9)] * 12 + [0] * 150)]
    df = spark.createDataFrame(rows, "g int, p int, x double, y double")
    cluster = lambda: sorted(map(str, places.density_clusters(df, "g", "p", F.col("x"), F.col("y"), 0.75).collect()))
    both = cluster()
    for n in (0, 1000):
        monkeypatch.setattr(places, "SMALL_GROUP", n)
        assert cluster() == both
    sent = []
    monkeypatch.setattr(places, "labelled", lambda links: sent.append(links._jdf.queryExecution().optimizedPlan().toString()) or labelled(links))
    cluster()
    assert "n_group" in sent[0]  # only larger groups come to the copies


def test_descent_is_dealt_over_tasks(spark, monkeypatch):
    files = []
    real = nearest.staged

    def counted(df, label):
        out = real(df, label)
        if label == "front":
            files.append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(nearest, "staged", counted)
    rows = spark.range(4000).select(F.col("id").alias("r"), F.lit(1).alias("g"), (F.col("id") * 37 % 101).cast("double").alias("x"), (F.col("id") * 91 % 103).cast("double").alias("y"))
    got = nearest.nearest_offers(rows.filter("r % 5 = 0"), rows.filter("r % 5 <> 0"), "g", "r", F.col("x"), F.col("y"))
    assert got.count() == 800 and len(files) > 1 and min(files[1:]) == 4
