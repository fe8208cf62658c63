"""Operator 7, mixing sources to target weights: hierarchical budgets over a domain-language-source tree.

The token budget is split from the root downwards. Among siblings it is shared in proportion to their weights; a child
that cannot use its share (its subtree holds fewer tokens times epochs) gets what it can, and the rest goes to its
siblings. So a shortage is made up by siblings, and by an ancestor's siblings only when the whole subtree is used up.
Each leaf then takes the token-prefix of its budget from seeded epochs: every epoch is a permutation of the leaf by a
seeded hash; whole epochs first, then the prefix of the next one. The prefix is found from token sums of hash buckets
and an exact running sum within one bucket per leaf, so no leaf, however large, is sorted in one place.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_GAP, is_small, stage

LEVELS = ("domain", "lang", "source")
#: Rows that a hash bucket holds on average, and leaves up to which their table is broadcast.
BUCKET_ROWS, LEAF_BOUND = 2000, 20_000


def n_words(text: Column) -> Column:
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), WORD_GAP), lambda w: w != "")).cast("long")


def weighted(nodes: DataFrame, weights: Mapping[str, float]) -> DataFrame:
    """nodes with a column weight: that of weights for the path a/b/c, or 1."""
    path = F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in LEVELS if c in nodes.columns])
    table = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv]) if weights else F.create_map().cast("map<string,double>")
    return nodes.withColumn("weight", F.coalesce(table[path].cast("double"), F.lit(1.0)))


def share_out(nodes: DataFrame, parent: Sequence[str]) -> DataFrame:
    """Each node's part of its parent's `given`, by weight and at most its capacity: nodes (.., capacity, weight, given).

    Siblings in the order of capacity by weight: the first ones are filled as long as their share of what is left is no
    less than their capacity; the others share the rest by weight.
    """
    near = Window.partitionBy(*parent)
    order = near.orderBy(F.col("capacity") / F.col("weight"), *[c for c in LEVELS if c in nodes.columns])
    before = F.coalesce(F.sum("capacity").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    ahead = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    out = nodes.filter("weight > 0").withColumn("rate", (F.col("given") - before) / ahead)
    open_rate = F.max(F.when(F.col("capacity") > F.col("rate") * F.col("weight"), F.col("rate"))).over(near)
    return out.withColumn("budget", F.when(open_rate.isNull() | (F.col("capacity") <= open_rate * F.col("weight")), F.col("capacity")).otherwise(open_rate * F.col("weight"))).drop("rate", "given")


def leaf_budgets(leaves: DataFrame, share: float, epochs: int, weights: Mapping[str, float]) -> DataFrame:
    """(domain, lang, source, rows, tokens, budget) from leaves (domain, lang, source, rows, tokens)."""
    leaves = leaves.withColumn("capacity", F.col("tokens") * float(epochs))
    given = leaves.agg((F.coalesce(F.sum("tokens"), F.lit(0)) * share).alias("budget")).withColumn("top", F.lit(1))
    parent: list[str] = ["top"]
    for depth in (1, 2, 3):
        names = list(LEVELS[:depth])
        nodes = leaves.groupBy(*names).agg(F.sum("capacity").alias("capacity")).withColumn("top", F.lit(1))
        up = given.select(*[F.col(c).alias(f"up_{c}") for c in parent], F.col("budget").alias("given"))
        same = [F.col(c).eqNullSafe(F.col(f"up_{c}")) for c in parent]
        nodes = nodes.join(up, same).drop(*[f"up_{c}" for c in parent])
        given = share_out(weighted(nodes, weights), parent)
        parent = names
    other = given.select(*[F.col(c).alias(f"o_{c}") for c in LEVELS], "budget")
    return leaves.join(other, [F.col(c).eqNullSafe(F.col(f"o_{c}")) for c in LEVELS], "left").select(*LEVELS, "rows", "tokens", F.coalesce("budget", F.lit(0.0)).alias("budget"))


def _place(id_col: Column, text_key: Column, seed: int, epoch: Column) -> Column:
    """The row's place in an epoch's permutation: 62 bits of a seeded hash."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), epoch, id_col, text_key), 2)


def mix_sources(docs: DataFrame, domain: Column, share: float = 0.8, epochs: int = 2, weights: Mapping[str, float] | None = None, seed: int = 11, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", into: str = "_times") -> DataFrame:
    """docs with a column `into` (int): how many epochs take the row, 0 for none.

    share of all tokens (words) is the budget; weights maps tree paths ("web", "web/en", "web/en/src1") to weights, 1
    where none is given; a weight of 0 takes nothing. A leaf's rows hold at most its budget in tokens, and the next row
    of its order would not fit.

    Null domains, languages and sources are values of their own. Null and empty texts have 0 tokens: they come along as
    their place in the order tells. Repeated rows (equal id and text) have one place and are taken together or not at
    all. Null ids are ordered by their text. All columns pass through; one named `into` is replaced. An empty table
    gives an empty table.
    """
    at = {"domain": domain.cast("string"), "lang": F.col(lang_col).cast("string"), "source": F.col(source_col).cast("string")}
    text_key = F.xxhash64(F.col(text_col))
    slim = docs.select(F.col(id_col).alias("id"), text_key.alias("key"), n_words(F.col(text_col)).alias("tokens"), *[c.alias(k) for k, c in at.items()])
    slim = stage(slim, "slim")
    leaves = slim.groupBy(*LEVELS).agg(F.count(F.lit(1)).alias("rows"), F.sum("tokens").alias("tokens"))
    budgets = stage(leaf_budgets(leaves, share, epochs, weights or {}), "budgets")
    whole = F.when(F.col("tokens") > 0, F.least(F.floor(F.col("budget") / F.col("tokens")), F.lit(epochs))).otherwise(F.lit(0)).cast("int")
    plan = budgets.withColumn("whole", whole).withColumn("rest", F.col("budget") - F.col("whole") * F.col("tokens")).withColumn("buckets", F.ceil(F.col("rows") / BUCKET_ROWS))
    plan = plan.select(*[F.col(c).alias(f"l_{c}") for c in LEVELS], "whole", "rest", "buckets")
    hint = F.broadcast if is_small(plan, LEAF_BOUND) else (lambda df: df)

    def leafed(df: DataFrame, extra: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
        return df.join(hint(extra), [columns[c].eqNullSafe(F.col(f"l_{c}")) for c in LEVELS])

    own = {c: F.col(c) for c in LEVELS}
    width = F.floor(F.lit(float(1 << 62)) / F.col("buckets")).cast("long") + 1
    placed = leafed(slim, plan, own).withColumn("place", _place(F.col("id"), F.col("key"), seed, F.col("whole"))).withColumn("bucket", F.floor(F.col("place") / width).cast("long"))
    sums = placed.groupBy(*LEVELS, "bucket").agg(F.sum("tokens").alias("in"), F.first("rest").alias("rest"), F.min("place").alias("from"))
    run = Window.partitionBy(*LEVELS).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    edge = sums.withColumn("upto", F.sum("in").over(run)).filter("upto > rest")
    edge = edge.groupBy(*LEVELS).agg(F.min_by(F.struct("bucket", (F.col("upto") - F.col("in")).alias("before"), "from"), "bucket").alias("e"))
    edge = stage(edge.select(*[F.col(c).alias(f"l_{c}") for c in LEVELS], F.col("e.bucket").alias("b"), F.col("e.before").alias("before"), F.col("e.from").alias("from")), "edge")
    inside = leafed(placed.drop(*[f"l_{c}" for c in LEVELS]), edge, own).filter("bucket = b")
    exact = Window.partitionBy(*LEVELS).orderBy("place").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    last = inside.withColumn("upto", F.col("before") + F.sum("tokens").over(exact)).filter("upto <= rest").groupBy(*LEVELS).agg(F.max("place").alias("last"))
    cuts = edge.join(last, [F.col(f"l_{c}").eqNullSafe(F.col(c)) for c in LEVELS], "left").select(*[F.col(f"l_{c}").alias(f"c_{c}") for c in LEVELS], F.coalesce("last", F.col("from") - 1).alias("cut"))
    # a leaf whose rest takes the whole next epoch has no edge: it is cut after its last row
    table = stage(plan.join(cuts, [F.col(f"l_{c}").eqNullSafe(F.col(f"c_{c}")) for c in LEVELS], "left").select(*[f"l_{c}" for c in LEVELS], F.col("whole").alias("_whole"), F.when(F.col("whole") >= epochs, F.lit(-1)).when(F.col("rest") <= 0, F.lit(-1)).otherwise(F.coalesce("cut", F.lit((1 << 62)))).alias("_cut")), "cuts")
    tagged = docs.select(F.struct(*[F.col(c) for c in docs.columns if c != into]).alias("row"), F.col(id_col).alias("id"), text_key.alias("key"), *[c.alias(k) for k, c in at.items()])
    joined = leafed(tagged, table, own)
    times = F.col("_whole") + (_place(F.col("id"), F.col("key"), seed, F.col("_whole")) <= F.col("_cut")).cast("int")
    return joined.select("row.*", times.alias(into))


def taken(mixed: DataFrame, into: str = "_times", epoch: str | None = None) -> DataFrame:
    """The rows as often as they are taken; epoch names a column for the epoch's number, from 0, which replaces one of
    that name."""
    row = F.struct(*[F.col(c) for c in mixed.columns if c not in (into, epoch)])
    out = mixed.filter(F.col(into) > 0).select(row.alias("row"), F.explode(F.sequence(F.lit(0), F.col(into) - 1)).alias("n"))
    return out.select("row.*", *([F.col("n").alias(epoch)] if epoch else []))
