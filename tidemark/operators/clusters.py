"""Clusters of similar strings inside a block, and what is made of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import strict_max, strict_mean, strict_min
from ..functions.similarity import jaro_bound, jaro_similarity, letter_counts
from ..functions.text import normalise_address
from ..sources.tables import staged, unstaged
from .components import labelled

#: Values of a block up to which all its pairs are made in one place; larger blocks are dealt into tiles.
TILE = 2_000


def similar_pairs(df: DataFrame, block: str, value: Column, threshold: float) -> DataFrame:
    """(block, a, b, distance): distinct normalised values of a block, a < b, of Jaro distance below the threshold.

    Values are normalised as addresses and made distinct first. A block of more than TILE values is dealt into parts by
    hash, and each pair of parts is compared in a place of its own. Pairs are bounded by their letter counts, in
    expressions, before the function is called. Null values have no pairs.
    """
    rows = df.select(F.col(block).alias("block"), normalise_address(value).alias("v")).filter("v is not null").distinct()
    rows = rows.withColumn("letters", letter_counts(F.col("v")))
    parts = rows.groupBy(F.col("block").alias("of")).agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("parts"))
    rows = rows.join(parts, F.col("block").eqNullSafe(F.col("of"))).withColumn("part", F.expr("pmod(xxhash64(v), parts)").cast("int"))
    other = F.sequence(F.lit(0), F.col("parts") - 1)
    tiles = F.transform(other, lambda q: F.struct(F.least("part", q).alias("p"), F.greatest("part", q).alias("q")))
    rows = rows.withColumn("t", F.explode(tiles)).select("block", F.col("t.p").alias("p"), F.col("t.q").alias("q"), "part", "v", "letters")
    x, y = (rows.toDF(*[f"{c}_{side}" for c in rows.columns]) for side in "xy")
    same = F.col("block_x").eqNullSafe(F.col("block_y")) & (F.col("p_x") == F.col("p_y")) & (F.col("q_x") == F.col("q_y"))
    across = (F.col("p_x") == F.col("q_x")) | (F.col("part_x") != F.col("part_y"))  # a diagonal tile holds one part
    short, long = F.least(F.length("v_x"), F.length("v_y")), F.greatest(F.length("v_x"), F.length("v_y"))
    pairs = x.join(y, same & (F.col("v_x") < F.col("v_y")) & across & (2 * long + short >= long * (3 - 3 * threshold - 1e-9)))
    pairs = pairs.filter(jaro_bound(F.col("v_x"), F.col("v_y"), F.col("letters_x"), F.col("letters_y")) > 1 - threshold - 1e-9)
    pairs = pairs.withColumn("distance", 1 - jaro_similarity("v_x", "v_y")).filter(F.col("distance") < threshold)
    return pairs.select(F.col("block_x").alias(block), F.col("v_x").alias("a"), F.col("v_y").alias("b"), "distance")


def clusters(df: DataFrame, block: str, value: str, threshold: float) -> DataFrame:
    """(block, value, cluster): connected components of similar values; cluster is its least value in binary order.

    Values are compared as normalised addresses, but the members are the values as they stand: those that differ in case
    or blanks alone are one cluster. With threshold 0 nothing is similar, and every value is its own cluster.
    """
    nodes = df.select(F.col(block).alias("block"), F.col(value).alias("value"), normalise_address(F.col(value)).alias("v")).filter("value is not null").distinct()
    if threshold <= 0:
        return nodes.select(F.col("block").alias(block), F.col("value").alias(value), F.col("value").alias("cluster"))
    pairs = similar_pairs(nodes, "block", F.col("value"), threshold)
    roots = labelled(pairs.select(F.col("block").alias("g"), "a", "b"))
    rooted = nodes.join(roots, F.col("block").eqNullSafe(F.col("g")) & (F.col("v") == F.col("node")), "left")
    rooted = staged(rooted.select("block", "value", "root", F.when(F.col("root").isNull(), F.col("v")).alias("alone")), "rooted")
    unstaged(roots)
    least = rooted.groupBy(F.col("block").alias("g"), F.col("root").alias("of"), F.col("alone").alias("by")).agg(F.min("value").alias("cluster"))
    out = rooted.join(least, F.col("block").eqNullSafe(F.col("g")) & F.col("root").eqNullSafe(F.col("of")) & F.col("alone").eqNullSafe(F.col("by")))
    return out.select(F.col("block").alias(block), F.col("value").alias(value), "cluster")


def exact_versus_similar(similar: DataFrame, block: str) -> DataFrame:
    """How many exact and similar clusters each block has, and whether as many."""
    out = similar.groupBy(block).agg(F.count(F.lit(1)).alias("n_exact"), F.count_distinct("cluster").alias("n_similar"))
    return out.withColumn("same_length", F.col("n_exact") == F.col("n_similar"))


def associated(rows: DataFrame, key: str, raw: str, line: str, labels: DataFrame, value: str, how: str = "exact") -> DataFrame:
    """rows with the cluster of the value each belongs to, from labels (key, value, cluster).

    how: `exact` ties a row to the cluster of its own raw value, one for each row. The two others are for comparison with
    older results, in which a row may land in several clusters. `regex`: in all clusters of the key with a member whose
    text before the first comma stands anywhere in the row's line, taken as a pattern. `prefix`: in those with a member
    that the row's raw value equals, or continues after a comma, whatever the case. Null lines and values have none.
    """
    inner = rows.select(F.col(key).alias("k"), F.col(raw).alias("raw"), F.col(line).alias("at_line"), F.struct("*").alias("row"))
    members = labels.select(F.col(key).alias("of"), F.col(value).alias("member"), "cluster")
    low, start = F.lower("raw"), F.lower("member")
    fits = {
        "exact": F.col("raw") == F.col("member"),
        "regex": F.expr("at_line rlike split_part(member, ',', 1)"),
        "prefix": (low == start) | F.startswith(low, F.concat(start, F.lit(","))),
    }[how]
    return inner.join(members, F.col("k").eqNullSafe(F.col("of")) & fits).select("row.*", "cluster").distinct()


def collapse(rows: DataFrame, key: str, value: str, labels: DataFrame, x: str, flags: dict[str, Column], reach: float) -> DataFrame:
    """One row for each cluster: member and row counts, summed flags, mean and range test of x (null if a value is). A null
    key is a key like any other; rows without a value belong to no cluster."""
    of = labels.select(F.col(key).alias("of_key"), F.col(value).alias("of_value"), F.col("cluster").alias("of_cluster"))
    inner = rows.select(F.col(key), F.col(value), F.col(x), *[f.alias(k) for k, f in flags.items()])
    joined = inner.join(of, F.col(key).eqNullSafe(F.col("of_key")) & (F.col(value) == F.col("of_value"))).withColumn("cluster", F.col("of_cluster"))
    near = F.when(F.count(F.lit(1)) == 1, F.lit(True)).otherwise(strict_max(F.col(x)) - strict_min(F.col(x)) < reach)
    sums = [F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in flags]
    return joined.groupBy(key, "cluster").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(value).alias("n_members"), *sums, strict_mean(F.col(x)).alias("mean_x"), near.alias("near_test"))


def expand_failed(rows: DataFrame, key: str, value: str, labels: DataFrame, collapsed: DataFrame, x: str, flags: dict[str, Column], reach: float) -> DataFrame:
    """Collapsed rows with each failed cluster replaced by its exact values, tagged Expanded."""
    failed = collapsed.filter(~F.coalesce("near_test", F.lit(True))).select(F.col(key).alias("of_key"), F.col("cluster").alias("of_cluster"))
    same = F.col(key).eqNullSafe(F.col("of_key")) & (F.col("cluster") == F.col("of_cluster"))
    exact = labels.join(failed, same, "left_semi").select(key, value, F.col(value).alias("cluster"))
    again = collapse(rows, key, value, exact, x, flags, reach).withColumn("near_test", F.when(F.col("n_rows") > 1, F.col("near_test"))).withColumn("status", F.lit("Expanded"))
    kept = collapsed.join(failed, same, "left_anti").withColumn("status", F.upper(F.col("near_test").cast("string")))
    return kept.unionByName(again)
