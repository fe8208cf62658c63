"""Profiles of ids that stand on several rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nulls import one_value, strict_max, strict_min, strict_sum
from ..sources.tables import staged
from . import scan


def counts_are_0_or_1(df: DataFrame, key: str, flags: Mapping[str, Column], into: str = "exclusive") -> DataFrame:
    """Whether every flag's sum over the key's rows is 0 or 1; a null in a flag makes it false."""
    inside = F.lit(True)
    for f in flags.values():
        inside = inside & F.coalesce(strict_sum(f).isin(0, 1), F.lit(False))
    return df.groupBy(key).agg(inside.alias(into))


def duplicate_profile(df: DataFrame, key: str, flags: Mapping[str, Column], same: Mapping[str, Column], near: Mapping[str, tuple[Column, float]]) -> DataFrame:
    """For every key with several rows: `exclusive` (no flag is set twice), each of `same` (one value, null being one)
    and each of `near` (the range is below a bound; null if a value is). One shuffle, on the key."""
    exclusive = F.lit(True)
    for f in flags.values():
        exclusive = exclusive & (F.coalesce(F.sum(f), F.lit(0)) <= 1)
    aggs = [F.count(F.lit(1)).alias("n_rows"), exclusive.alias("exclusive")]
    aggs += [one_value(c).alias(k) for k, c in same.items()]
    aggs += [(strict_max(c) - strict_min(c) < bound).alias(k) for k, (c, bound) in near.items()]
    return df.groupBy(key).agg(*aggs).filter("n_rows > 1")


def contingency(df: DataFrame, by: Sequence[str], with_null: bool = False) -> DataFrame:
    """Counts of every combination of the levels that occur, with 0 where none does, and per cent of all rows."""
    seen = df if with_null else df.dropna(subset=list(by))
    counts = seen.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).select(*[F.col(c).alias(f"_{c}") for c in by], "n")
    grid = None
    for c in by:  # levels are few by the nature of such a table
        levels = seen.select(c).distinct()
        grid = levels if grid is None else grid.crossJoin(levels)
    joined = grid.join(counts, [grid[c].eqNullSafe(F.col(f"_{c}")) for c in by], "left").select(*by, F.coalesce("n", F.lit(0)).alias("n"))
    return joined.withColumn("pct", F.round(F.col("n") * 10000 / F.sum("n").over(Window.partitionBy())) / 100)


#: Values of a group up to which its quantiles are taken from one buffer; pairs of a key up to which all are measured.
SMALL_GROUP, SMALL_PAIRS = 10_000, 10_000
#: Ranks of a sketch are off by one in so many at most.
ACCURACY = 10_000


def _selected(df: DataFrame, keys: list[str], ps: Sequence[float]) -> DataFrame:
    """(keys, q array<double>): exact quantiles ps of x, interpolated between ranks, for groups of any size.

    Sketches that merge bracket each rank by two values of the group. Only the values inside the brackets are counted, equal
    ones together before they are shuffled, and only these are put in order, by ranges.
    """
    slack = 2 / ACCURACY
    asked = [min(max(p + d, 0.0), 1.0) for p in ps for d in (-slack, slack)]
    sketch = df.groupBy(*keys).agg(F.count("x").alias("n"), F.min("x").alias("least"), F.max("x").alias("most"), F.percentile_approx("x", F.lit(asked), F.lit(ACCURACY)).alias("b"))
    edge = lambda k, p, low: F.col("least") if low and p <= slack else F.col("most") if not low and p >= 1 - slack else F.col("b")[2 * k + (not low)]
    brackets = F.array(*[F.struct(F.lit(k).alias("at"), edge(k, p, True).alias("lo"), edge(k, p, False).alias("hi"), (F.lit(p) * (F.col("n") - 1)).alias("rank")) for k, p in enumerate(ps)])
    sketch = staged(sketch.select(*[F.col(c).alias(f"g_{c}") for c in keys], brackets.alias("brackets")), "brackets")
    same = F.lit(True)
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"g_{c}"))
    met = df.filter("x is not null").join(sketch, same).select(*keys, "x", F.explode("brackets").alias("b"))
    met = met.select(*keys, F.col("b.at").alias("at"), F.col("b.rank").alias("rank"), F.when(F.col("x") >= F.col("b.lo"), F.col("x")).alias("v"), "x", F.col("b.hi").alias("hi")).filter("x <= hi")
    counts = met.groupBy(*keys, "at", "rank", "v").agg(F.count(F.lit(1)).alias("n"))  # a null v stands for all below the bracket
    rows = scan.scan(scan.ranged(counts, [*keys, "at"], ["v"]), {"upto": ("sum", F.col("row.n"))})
    held = lambda r: F.min(F.when((F.col("upto") > r) & F.col("row.v").isNotNull(), F.col("row.v")))
    rank = F.col("row.rank")
    one = rows.groupBy(*[F.col(f"row.{c}").alias(c) for c in keys], F.col("row.at").alias("at"), rank.alias("rank")).agg(held(F.floor(rank)).alias("a"), held(F.ceil(rank)).alias("b"))
    value = F.col("a") + (F.col("b") - F.col("a")) * (F.col("rank") - F.floor("rank"))
    return one.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", value.alias("v")))), lambda s: s["v"]).alias("q"))


def quantile_summary(df: DataFrame, by: Sequence[str], x: Column, small: int = SMALL_GROUP) -> DataFrame:
    """(by, min, q1, median, q3, mean, max) of each group, a null in `by` being a value: exact quartiles, interpolated
    between ranks. Groups of at most `small` values have theirs from one buffer, larger ones by selection. Null values do
    not count; a group of nulls alone has nulls."""
    keys, ps = [f"k{i}" for i in range(len(by))], (0.25, 0.5, 0.75)
    rows = df.select(*[F.col(c).alias(k) for c, k in zip(by, keys, strict=True)], x.cast("double").alias("x"))
    whole = staged(rows.groupBy(*keys).agg(F.count("x").alias("n"), F.min("x").alias("min"), F.avg("x").alias("mean"), F.max("x").alias("max")), "groups")
    of = whole.select(*[F.col(k).alias(f"h_{k}") for k in keys], (F.col("n") > small).alias("large"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"h_{k}"))
    parted = rows.join(of, same)
    q = parted.filter(~F.col("large")).groupBy(*keys).agg(F.percentile("x", F.lit(list(ps))).alias("q"))
    if not of.filter("large").isEmpty():
        q = q.unionByName(_selected(parted.filter("large").select(*keys, "x"), keys, ps))
    q = q.toDF(*[f"h_{k}" for k in keys], "q")
    out = whole.join(q, same)
    return out.select(*[F.col(k).alias(c) for c, k in zip(by, keys, strict=True)], "min", *[F.col("q")[i].alias(k) for i, k in enumerate(("q1", "median", "q3"))], "mean", "max")


def unique_info(df: DataFrame, by: Sequence[str], info: Sequence[str], order: Sequence[str]) -> DataFrame:
    """df with has_duplicates for the group, and is_unique: null for a lone row, else whether the row is the first of its
    info. The order tells a group's rows apart. Counts and firsts are aggregated before the shuffle and joined back."""
    keys, parts = [f"k{i}" for i in range(len(by))], [f"i{i}" for i in range(len(info))]
    inner = df.select(F.struct(*df.columns).alias("row"), *[F.col(c).alias(k) for c, k in zip((*by, *info), (*keys, *parts), strict=True)], F.struct(*order).alias("at"))
    firsts = staged(inner.groupBy(*keys, *parts).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")), "firsts")
    groups = firsts.groupBy(*keys).agg(F.sum("n").alias("size"), F.max(F.col("n") > 1).alias("twice"))

    def on(left: list[str], right: list[str]) -> Column:
        out = F.lit(True)
        for a, b in zip(left, right, strict=True):
            out = out & F.col(a).eqNullSafe(F.col(b))
        return out

    groups = groups.toDF(*[f"g_{k}" for k in keys], "size", "twice")
    known = firsts.join(groups, on(keys, [f"g_{k}" for k in keys])).select(*[F.col(c).alias(f"f_{c}") for c in (*keys, *parts)], "first", "size", "twice")
    out = inner.join(known, on([*keys, *parts], [f"f_{c}" for c in (*keys, *parts)]))
    names = [c for c in df.columns if c not in ("has_duplicates", "is_unique")]
    return out.select(*[F.col(f"row.{c}").alias(c) for c in names], F.col("twice").alias("has_duplicates"), F.when(F.col("size") > 1, F.col("at") == F.col("first")).alias("is_unique"))


_FAR = ("n_total", "n_failed", "near_any", "failed_min", "failed_mean", "failed_max")


def _far_by_scan(mine: DataFrame, others: DataFrame, bound: float) -> DataFrame:
    """(key, row, ..) as the audit has them, for keys with many rows: a row's far others are those up to x - bound and from
    x + bound on, so running counts and sums over the sorted others answer each row at its two places."""
    at = lambda df, kind, x, row: df.select("key", row.alias("row"), x.alias("at"), F.lit(kind).alias("kind"))
    line = at(others, 1, F.col("y"), F.lit(None).cast(mine.schema["row"].dataType)).unionByName(at(mine, 2, F.col("x") - bound, F.col("row"))).unionByName(at(mine, 0, F.col("x") + bound, F.col("row")))
    line = line.withColumn("nth", F.monotonically_increasing_id())
    rows = scan.ranged(line, ["key"], ["at", "kind", "nth"])
    y = F.when(F.col("row.kind") == 1, F.col("row.at"))
    rows = scan.scan(rows, {"count": ("sum", y.isNotNull().cast("long")), "total": ("sum", y), "below": ("max", y), "above": ("least", y)})
    place = rows.filter("row.kind <> 1").groupBy(F.col("row.key").alias("key"), F.col("row.row").alias("row"))
    low, high = (lambda c, k=k: F.max(F.when(F.col("row.kind") == k, F.col(c))) for k in (2, 0))
    found = place.agg(low("count").alias("n_low"), low("total").alias("s_low"), low("below").alias("below"), high("count").alias("n_upto"), high("total").alias("s_upto"), high("above").alias("above"))
    every = others.groupBy(F.col("key").alias("k")).agg(F.count("y").alias("n"), F.sum("y").alias("s"), F.min("y").alias("y_lo"), F.max("y").alias("y_hi"))
    out = mine.join(found.toDF("k1", "r1", *found.columns[2:]), F.col("key").eqNullSafe(F.col("k1")) & (F.col("row") == F.col("r1"))).join(every, F.col("key").eqNullSafe(F.col("k")))
    x, n_high = F.col("x"), F.col("n") - F.col("n_upto")
    failed = F.col("n_low") + n_high
    total = x * F.col("n_low") - F.col("s_low") + (F.col("s") - F.col("s_upto")) - x * n_high
    far = lambda a, b: (F.when(F.col("n_low") > 0, x - F.col(a)), F.when(n_high > 0, F.col(b) - x))
    return out.select("key", "row", F.col("n").alias("n_total"), failed.alias("n_failed"), (failed < F.col("n")).alias("near_any"), F.least(*far("below", "above")).alias("failed_min"), (total / F.nullif(failed, F.lit(0))).alias("failed_mean"), F.greatest(*far("y_lo", "y_hi")).alias("failed_max"))


def proximity_audit(df: DataFrame, key: str, boxed: Column, row: str, x: Column, bound: float, small: int = SMALL_PAIRS) -> DataFrame:
    """For each boxed row: its differences in x from the key's other rows, and how many of them reach the bound (the other
    lies at x - bound or below, or at x + bound or above).

    Boxed rows without others, or without x, stay with null outcomes. Rows tell a key's boxed rows apart; a null key is a
    key. Keys of at most `small` pairs are joined, larger ones answered by running sums over their sorted rows, in work that
    does not grow with the pairs.
    """
    rows = df.select(F.col(key).alias("key"), F.col(row).alias("row"), x.cast("double").alias("x"), F.coalesce(boxed, F.lit(False)).alias("boxed"))
    size = rows.groupBy(F.col("key").alias("of")).agg((F.count_if("boxed") * F.count_if(~F.col("boxed")) > small).alias("large"))
    rows = staged(rows.join(size, F.col("key").eqNullSafe(F.col("of"))).drop("of"), "audited")
    mine, others = rows.filter("boxed").drop("boxed"), rows.filter("not boxed and x is not null").select("key", F.col("x").alias("y"), "large")
    few = mine.filter("not large").join(others.filter("not large").select(F.col("key").alias("k"), "y"), F.col("key").eqNullSafe(F.col("k")), "left")
    d, reaches = F.abs(F.col("x") - F.col("y")), (F.col("y") <= F.col("x") - bound) | (F.col("y") >= F.col("x") + bound)
    far, known = F.when(reaches, d), F.col("y").isNotNull() & F.col("x").isNotNull()
    out = few.groupBy("key", "row").agg(F.count_if(known).alias("n_total"), F.count(far).alias("n_failed"), F.bool_or(~reaches).alias("near_any"), F.min(far).alias("failed_min"), F.avg(far).alias("failed_mean"), F.max(far).alias("failed_max"))
    if not rows.filter("large").isEmpty():
        many = mine.filter("large").drop("large")
        out = out.unionByName(_far_by_scan(many.filter("x is not null"), others.filter("large").drop("large"), bound))
        out = out.unionByName(many.filter("x is null").select("key", "row", F.lit(0).cast("long").alias("n_total"), F.lit(0).cast("long").alias("n_failed"), F.lit(None).cast("boolean").alias("near_any"), *[F.lit(None).cast("double").alias(c) for c in _FAR[3:]]))
    return out.select(F.col("key").alias(key), F.col("row").alias(row), *_FAR[:3], *[F.bround(c, 3).alias(c) for c in _FAR[3:]])
