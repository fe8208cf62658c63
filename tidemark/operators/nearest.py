"""The nearest offered point of each asking point, inside groups, exactly and without all pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import by_rows, staged, unstaged
from .places import distance

#: Pairs of a group up to which all are measured at once, and points of a cell up to which its points are measured.
SMALL_GROUP, LEAF = 10_000, 64
#: A level cuts each side of a cell in 2 ** STEP; the finest cells have 2 ** -DEPTH of a group's side.
STEP, DEPTH = 3, 24
_SLACK = 1 + 1e-9  # bounds and distances are rounded on different ways


def _beyond(q: str, lo: str, hi: str) -> Column:
    """How far a coordinate lies outside of an interval."""
    return F.greatest(F.col(lo) - F.col(q), F.col(q) - F.col(hi), F.lit(0.0))


def _descended(asks: DataFrame, spots: DataFrame, reach: float) -> DataFrame:
    """(ask, best): the nearest of spots (h, x, y, offer) for asks (g, qx, qy, ask), by branch and bound down a grid.

    A group's square is cut into smaller ones again and again. Each level knows the box of a cell's points, hence how near the
    nearest of them may be and how far at most; a question goes down into the cells that may still hold its nearest point.
    """
    frame = spots.groupBy("h").agg(F.min("x").alias("x0"), F.min("y").alias("y0"), F.greatest(F.max("x") - F.min("x"), F.max("y") - F.min("y")).alias("side"))
    grid = lambda c, o: F.least(F.floor((F.col(c) - F.col(o)) / F.col("side") * float(1 << DEPTH)), F.lit((1 << DEPTH) - 1)).cast("long")
    inner = spots.join(frame.withColumnRenamed("h", "of"), F.col("h").eqNullSafe(F.col("of")))
    inner = inner.select("h", "x", "y", "offer", F.coalesce(F.when(F.col("side") > 0, grid("x", "x0")), F.lit(0)).alias("i"), F.coalesce(F.when(F.col("side") > 0, grid("y", "y0")), F.lit(0)).alias("j"))
    inner = staged(inner, "spots")

    def at(level: int) -> list[Column]:
        return [F.shiftright("i", DEPTH - level).alias("ci"), F.shiftright("j", DEPTH - level).alias("cj")]

    def cells(level: int) -> DataFrame:
        box = [F.min("x").alias("x_lo"), F.max("x").alias("x_hi"), F.min("y").alias("y_lo"), F.max("y").alias("y_hi"), F.count(F.lit(1)).alias("n")]
        return inner.groupBy("h", *at(level)).agg(*box)

    def bounded(pairs: DataFrame) -> DataFrame:
        """pairs (g, ask, qx, qy, bound, cell) that may hold the nearest point, with the least bound of each question."""
        near = F.hypot(_beyond("qx", "x_lo", "x_hi"), _beyond("qy", "y_lo", "y_hi"))
        far = F.hypot(F.greatest(F.abs(F.col("qx") - F.col("x_lo")), F.abs(F.col("qx") - F.col("x_hi"))), F.greatest(F.abs(F.col("qy") - F.col("y_lo")), F.abs(F.col("qy") - F.col("y_hi"))))
        told = pairs.select("g", "ask", "qx", "qy", "bound", "ci", "cj", "n", near.alias("near"), far.alias("far"))
        best = told.groupBy(F.col("ask").alias("of")).agg(F.least(F.min("far") * _SLACK, F.min("bound")).alias("best"))  # a few cells a question
        return told.join(by_rows(best), F.col("ask") == F.col("of")).filter(F.col("near") <= F.col("best") * _SLACK).select("g", "ask", "qx", "qy", F.col("best").alias("bound"), "ci", "cj", "n")

    root = cells(0)
    front = staged(bounded(asks.join(root, F.col("g").eqNullSafe(F.col("h"))).withColumn("bound", F.lit(float(reach)))), "front")
    found, level, held = [], 0, []
    parts = int(asks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while True:
        leaf = F.col("n") <= LEAF if level < DEPTH else F.lit(True)
        of = inner.select("h", "x", "y", "offer", *at(level))
        hit = front.filter(leaf).withColumnsRenamed({"ci": "a", "cj": "b"}).join(by_rows(of), F.col("g").eqNullSafe(F.col("h")) & (F.col("a") == F.col("ci")) & (F.col("b") == F.col("cj")))
        hit = hit.select("ask", F.struct(distance(hit, ("qx", "qy"), ("x", "y")).alias("distance"), "offer").alias("pair"), "bound")
        found.append(staged(hit.filter("pair.distance <= bound").groupBy("ask").agg(F.min("pair").alias("best")), "found"))
        held.append(front)
        down = front.filter(~leaf)
        if level == DEPTH or down.isEmpty():
            break
        level += STEP
        below = cells(level).withColumns({"pi": F.shiftright("ci", STEP), "pj": F.shiftright("cj", STEP)})
        down = down.select("g", "ask", "qx", "qy", "bound", F.col("ci").alias("a"), F.col("cj").alias("b"))
        down = down.repartition(parts, "ask")  # a small file otherwise, whose one task would make 64 rows of each
        front = staged(bounded(down.join(below, F.col("g").eqNullSafe(F.col("h")) & (F.col("a") == F.col("pi")) & (F.col("b") == F.col("pj")))), "front")
    every = found[0]
    for df in found[1:]:
        every = every.unionByName(df)
    out = staged(every.groupBy("ask").agg(F.min("best").alias("best")), "nearest")
    unstaged(inner, *held, *found)
    return out


def nearest_offers(asks: DataFrame, offers: DataFrame, by: str, row: str, x: Column, y: Column, reach: float = float("inf")) -> DataFrame:
    """(by, row, offer, distance) of every row of asks: the row of the nearest point of offers in the same group.

    Ties go to the least row; beyond `reach`, in a group without offers and for rows without coordinates both are null.
    by, row, x and y are of both tables; rows must tell asks apart within a group. A null group is a group. Points at one
    place count once on both sides, so neither a place that many share nor a crowded cell makes all pairs: groups of few
    pairs are measured at once, larger ones by going down a grid. Decimal coordinates are measured exactly, others as doubles.
    """
    told = lambda df: df.select(F.col(by).alias("g"), F.col(row).alias("r"), x.alias("x"), y.alias("y"))
    real = "x is not null and y is not null and not isnan(x) and not isnan(y)"
    spots = staged(told(offers).filter(real).groupBy(F.col("g").alias("h"), "x", "y").agg(F.min("r").alias("offer")), "spots")
    places = told(asks).filter(real).select("g", F.col("x").alias("qx"), F.col("y").alias("qy")).distinct()
    places = staged(places.withColumn("ask", F.monotonically_increasing_id()), "asks")
    n_spots, n_asks = spots.groupBy("h").agg(F.count(F.lit(1)).alias("s")), places.groupBy("g").agg(F.count(F.lit(1)).alias("a"))
    large = staged(n_asks.join(by_rows(n_spots), F.col("g").eqNullSafe(F.col("h"))).filter(F.col("a") * F.col("s") > SMALL_GROUP).select(F.col("g").alias("large")), "large")
    of = lambda df, g, how: df.join(large, F.col(g).eqNullSafe(F.col("large")), how)
    pairs = of(places, "g", "left_anti").join(by_rows(of(spots, "h", "left_anti")), F.col("g").eqNullSafe(F.col("h")))
    pairs = pairs.select("ask", F.struct(distance(pairs, ("qx", "qy"), ("x", "y")).alias("distance"), "offer").alias("pair")).filter(F.col("pair.distance") <= reach)
    best = pairs.groupBy("ask").agg(F.min("pair").alias("best"))
    if not large.isEmpty():
        best = best.unionByName(_descended(of(places, "g", "left_semi"), of(spots, "h", "left_semi"), reach))
    answers = places.join(by_rows(best), "ask").select(F.col("g").alias("h"), "qx", "qy", "best")
    same = F.col("g").eqNullSafe(F.col("h")) & (F.col("x") == F.col("qx")) & (F.col("y") == F.col("qy"))
    out = told(asks).join(by_rows(answers), same, "left").select(F.col("g").alias(by), F.col("r").alias(row), F.col("best.offer").alias("offer"), F.col("best.distance").alias("distance"))
    return out
