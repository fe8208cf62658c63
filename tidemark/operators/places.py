"""Points: clusters by distance, gaps on a line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import by_rows, staged
from . import scan
from .components import labelled


#: Rows of a group up to which all its pairs of points are looked at; larger groups are cut into squares and their neighbours.
SMALL_GROUP = 64


def distance(df: DataFrame, a: tuple[str, str], b: tuple[str, str]) -> Column:
    """The distance of two points by their columns of df. Decimals are subtracted and squared as such (exactly up to 17
    digits), so points as far on one side as on the other are tied as well, which binary tenths are not; and the root is
    of the sum as SQL would state it, not by hypot, which rounds otherwise."""
    kinds = dict(df.dtypes)
    gaps = [F.col(p) - F.col(q) if kinds[p].startswith("decimal") and kinds[q].startswith("decimal") else F.col(p).cast("double") - F.col(q).cast("double") for p, q in zip(a, b, strict=True)]
    return F.sqrt((gaps[0] * gaps[0]).cast("double") + (gaps[1] * gaps[1]).cast("double"))


def gap_clusters(df: DataFrame, by: str, x: Column, row: str, eps: float) -> DataFrame:
    """(by, row, x, cluster): density clusters of two points or more on a line, numbered from 1 in each group among the
    runs without a gap above eps; noise is 0. Rows are scanned by ranges, so a group of any size uses many tasks. Null x
    are noise; they come first, and each counts as a run."""
    rows = scan.ranged(df.select(F.col(by).alias("g"), F.col(row).alias("p"), x.alias("x")), ["g"], ["x", "p"])
    at = F.col("row.x")
    rows = scan.scan(rows, {"before": ("prev", at)}).withColumn("new", F.coalesce((at - F.col("before") > eps).cast("int"), F.lit(1)))
    rows = scan.scan(rows, {"run": ("sum", F.col("new")), "then": ("next", F.col("new"))})
    paired = (F.col("new") == 0) | F.coalesce(F.col("then") == 0, F.lit(False))
    return rows.select(F.col("row.g").alias(by), F.col("row.p").alias(row), at.alias("x"), F.when(paired, F.col("run")).otherwise(0).alias("cluster"))


def density_clusters(df: DataFrame, by: str, row: str, x: Column, y: Column, eps: float) -> DataFrame:
    """Density clusters of two points or more in the plane: (by, row, cluster, is_noise, problem_geo). cluster is the least
    row of its points, and null for noise, which is_noise tells. A group in which a coordinate lacks is one cluster, with
    problem_geo.

    Points fall into squares whose diagonal is eps, so all points of a square are one cluster; squares are joined if two
    of their distinct points lie within eps. So a place that many rows share costs one point. Points of a large group are
    sent to the squares around theirs, twelve copies each; those of a small one meet in their group, without copies.
    """
    side = eps / 2**0.5
    pts = df.select(F.col(by).alias("g"), F.col(row).alias("p"), x.alias("x"), y.alias("y"))
    groups = pts.groupBy(F.col("g").alias("of")).agg(F.bool_or(F.col("x").isNull() | F.col("y").isNull()).alias("lacking"), F.count(F.lit(1)).alias("n_group"), F.min("p").alias("first"))
    cells = pts.join(by_rows(groups), F.col("g").eqNullSafe(F.col("of"))).drop("of").withColumns({"i": F.floor(F.col("x") / side), "j": F.floor(F.col("y") / side)})
    whole = staged(cells.withColumn("cell", F.struct("i", "j")), "cells")
    cells = whole.filter("not lacking")
    own = cells.filter(F.col("n_group") <= SMALL_GROUP).select(F.struct("g").alias("key"), "i", "j", "x", "y").repartition("key").distinct()  # a struct of null equals itself
    other = own.select(F.col("key").alias("of"), F.col("i").alias("k"), F.col("j").alias("l"), F.col("x").alias("u"), F.col("y").alias("v"))
    after = (F.col("k") > F.col("i")) | ((F.col("k") == F.col("i")) & (F.col("l") > F.col("j")))
    few = own.join(by_rows(other), (F.col("key") == F.col("of")) & after)
    few = few.filter(distance(few, ("x", "y"), ("u", "v")) <= eps).select("key.g", F.struct("i", "j").alias("a"), F.struct(F.col("k").alias("i"), F.col("l").alias("j")).alias("b"))
    spots = cells.filter(F.col("n_group") > SMALL_GROUP).select("g", "cell", "i", "j", "x", "y").distinct()
    near = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in range(-2, 3) for b in range(-2, 3) if (a, b) > (0, 0)]))
    wide = spots.withColumn("o", near).select(F.col("g").alias("h"), F.col("cell").alias("d"), F.col("x").alias("u"), F.col("y").alias("v"), (F.col("i") + F.col("o.a")).alias("k"), (F.col("j") + F.col("o.b")).alias("l"))
    links = spots.join(by_rows(wide), F.col("g").eqNullSafe(F.col("h")) & (F.col("i") == F.col("k")) & (F.col("j") == F.col("l")))
    links = links.filter(distance(links, ("x", "y"), ("u", "v")) <= eps).select("g", F.col("cell").alias("a"), F.col("d").alias("b")).unionByName(few).distinct()
    roots = labelled(links).select(F.col("g").alias("h"), "node", "root")
    found = cells.join(by_rows(roots), F.col("g").eqNullSafe(F.col("h")) & (F.col("cell") == F.col("node")), "left")
    found = found.select("g", "p", "root", F.when(F.col("root").isNull(), F.col("cell")).alias("alone"))
    sizes = found.groupBy(F.col("g").alias("h"), F.col("root").alias("of"), F.col("alone").alias("by")).agg(F.min("p").alias("least"), F.count(F.lit(1)).alias("n"))
    same = F.col("g").eqNullSafe(F.col("h")) & F.col("root").eqNullSafe(F.col("of")) & F.col("alone").eqNullSafe(F.col("by"))
    told = found.join(by_rows(sizes), same).select("g", "p", F.when(F.col("n") > 1, F.col("least")).alias("cluster"), (F.col("n") == 1).alias("is_noise"), F.lit(False).alias("problem_geo"))
    odd = whole.filter("lacking").select("g", "p", F.col("first").alias("cluster"), F.lit(False).alias("is_noise"), F.lit(True).alias("problem_geo"))
    return told.unionByName(odd).select(F.col("g").alias(by), F.col("p").alias(row), "cluster", "is_noise", "problem_geo")
