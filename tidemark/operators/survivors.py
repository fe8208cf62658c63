"""Which of several competing records of one id stays."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import is_mailbox
from ..sources.tables import by_rows, staged
from .cities import matched_cities
from .nearest import nearest_offers
from .places import density_clusters

NO_MATCH = "No address match found"
#: Characters that two lines' lengths may differ by to count as alike.
LENGTH_REACH = 2


def introduced(df: DataFrame, key: str, flags: Mapping[str, Column]) -> DataFrame:
    """df with `introduced`: whether a flag that several rows of the key have is set on the row.

    The sums are aggregated per key and joined back, so that a key's rows are not gathered in one place."""
    inner = df.select(F.col(key).alias("k"), F.struct("*").alias("row"), *[f.alias(f"f{i}") for i, f in enumerate(flags.values())])
    names = [f"f{i}" for i in range(len(flags))]
    sums = inner.groupBy(F.col("k").alias("of")).agg(*[(F.sum(c) > 1).alias(f"over_{c}") for c in names])
    joined = inner.join(by_rows(sums), F.col("k").eqNullSafe(F.col("of")))
    hit = F.lit(False)
    for c in names:
        hit = hit | (F.coalesce(f"over_{c}", F.lit(False)) & (F.coalesce(c, F.lit(0)) == 1))
    return joined.select("row.*", hit.alias("introduced"))


def survivor_ladder(df: DataFrame, by: list[str], row: str, answer: Column, line: Column, extra: Column, city: str, state: str, zip_: str, gazetteer: DataFrame, threshold: float) -> DataFrame:
    """df with `decision` (Keep for one row of each group, Drop for the others), `by_city` (the row was kept because its
    city is like one of the gazetteer's, whose name its column `city` has now) and `needs_review` (no row of the group was
    verified).

    In order: rows without a validated answer go, unless all are so. If a row has a second line, those without go. If a
    first line with a digit is the longest, only such stay; else if the longest shares a run of lengths, each within
    LENGTH_REACH of the next, with one that has a digit, all with a digit stay; else the longest. Of several left, the
    first whose city the gazetteer (city, state_id, zip) has stays, or else the one whose city is most similar to a place
    of its state and ZIP (Jaro distance below the threshold), or else the first by `row`. A null in `by` is a value like
    any other. A group is the records of one id at one place, so a window over it is small.
    """
    known = matched_cities(df, F.col(city), F.col(state), F.col(zip_), gazetteer, threshold).toDF("c", "s", "z", "known", "place", "far")
    keys = [f"by{i}" for i in range(len(by))]
    facts = df.select(F.struct(*df.columns).alias("r"), *[F.col(c).alias(k) for c, k in zip(by, keys, strict=True)], F.col(row).alias("nth"), F.coalesce(answer == NO_MATCH, F.lit(False)).alias("none"), extra.isNotNull().alias("extra"), F.coalesce(F.length(line), F.lit(0)).alias("len"), F.coalesce(line.rlike("[0-9]"), F.lit(False)).alias("digit"))
    same = F.col(f"r.{city}").eqNullSafe(F.col("c")) & F.col(f"r.{state}").eqNullSafe(F.col("s")) & F.col(f"r.{zip_}").eqNullSafe(F.col("z"))
    out = facts.join(known, same)
    group = Window.partitionBy(*keys)
    any_ = lambda c: F.coalesce(F.max(c).over(group), F.lit(False))
    out = out.withColumn("review", F.min("none").over(group)).withColumn("live", ~F.col("none") | F.col("review"))
    out = out.withColumn("live", F.col("live") & (F.col("extra") | ~any_(F.col("live") & F.col("extra"))))
    out = out.withColumn("top", F.col("live") & (F.col("len") == F.max(F.when(F.col("live"), F.col("len"))).over(group)))
    line_up = Window.partitionBy(*keys, "live").orderBy("len")
    out = out.withColumn("new", F.coalesce((F.col("len") - F.lag("len").over(line_up) > LENGTH_REACH).cast("int"), F.lit(1)))
    out = out.withColumn("run", F.sum("new").over(line_up.rangeBetween(Window.unboundedPreceding, 0)))  # equal lengths have one run
    top_run = F.max(F.when(F.col("top"), F.col("run"))).over(group)
    digit = F.col("live") & F.col("digit")
    out = out.withColumns({"both": any_(digit & F.col("top")), "close": any_(digit & (F.col("run") == top_run))})
    out = out.withColumn("live", F.when(F.col("both"), digit & F.col("top")).when(F.col("close"), digit).otherwise(F.col("top")))
    order = group.orderBy(F.col("live").desc(), F.col("known").desc(), F.when(F.col("known"), None).otherwise(F.col("far")).asc_nulls_last(), "nth")
    several = F.sum(F.col("live").cast("int")).over(group) > 1
    out = out.withColumn("kept", F.row_number().over(order) == 1)
    out = out.withColumn("by_city", F.col("kept") & several & ~F.col("known") & F.col("place").isNotNull())
    named = [F.when(F.col("by_city"), F.col("place")).otherwise(F.col(f"r.{c}")).alias(c) if c == city else F.col(f"r.{c}") for c in df.columns]
    return out.select(*named, F.when(F.col("kept"), "Keep").otherwise("Drop").alias("decision"), "by_city", F.col("review").alias("needs_review"))


def select_survivors(df: DataFrame, key: str, row: str, flags: Mapping[str, Column], x: Column, y: Column, eps: float, answer: Column, address: Column, **ladder) -> DataFrame:
    """df with cluster, is_noise, problem_geo, decision, by_city, needs_review and lender: rows that no flag makes a
    duplicate are kept as they are (cluster and is_noise null); the others compete by the ladder with those of their key's
    density cluster, noise being one.

    Where no row of a group was verified, the one that the ladder would keep borrows: the nearest row of its key within
    eps that stays, has an answer and whose address is no mailbox stands in for the group. lender names it, and the row goes.
    Without such a row it stays, marked by needs_review alone. Rows without a key are rows of the null key.
    """
    marked = staged(introduced(df, key, flags), "marked")
    some = marked.filter("introduced").drop("introduced")
    places = density_clusters(some, key, row, x, y, eps).toDF("g", "p", "cluster", "is_noise", "problem_geo")
    inner = some.select(F.struct(*some.columns).alias("r")).join(by_rows(places), F.col(f"r.{key}").eqNullSafe(F.col("g")) & (F.col(f"r.{row}") == F.col("p")))
    joined = inner.select("r.*", "cluster", "is_noise", "problem_geo")
    judged = staged(survivor_ladder(joined, [key, "cluster", "is_noise"], row, answer=answer, **ladder), "judged")
    stay = judged.filter("decision = 'Keep' and not needs_review").select(*[c for c in marked.columns if c != "introduced"]).unionByName(marked.filter("not introduced").drop("introduced"))
    offers = stay.filter((answer != NO_MATCH) & ~F.coalesce(is_mailbox(address), F.lit(False)))
    lent = nearest_offers(judged.filter("decision = 'Keep' and needs_review"), offers, key, row, x, y, eps).filter("offer is not null")
    lent = lent.select(F.col(key).alias("g"), F.col(row).alias("p"), "offer")
    whole = judged.select(F.struct(*judged.columns).alias("r")).join(by_rows(lent), F.col(f"r.{key}").eqNullSafe(F.col("g")) & (F.col(f"r.{row}") == F.col("p")), "left")
    whole = whole.select("r.*", F.col("offer").alias("lender")).withColumn("decision", F.when(F.col("lender").isNotNull(), "Drop").otherwise(F.col("decision")))
    alone = marked.filter(~F.col("introduced")).drop("introduced")
    return whole.unionByName(alone.withColumn("decision", F.lit("Keep")), allowMissingColumns=True).na.fill(False, ["by_city", "needs_review", "problem_geo"])


def _group(key: str) -> list[Column]:
    return [F.col(key).alias("g"), F.col("cluster").alias("h"), F.col("is_noise").alias("i")]


def compressed(judged: DataFrame, key: str, row: str, flags: Mapping[str, str]) -> DataFrame:
    """judged with the flags of each kept row set where any row of its group has them, or of a group that borrowed it;
    others as they are. flags: column of judged by name of the result's column."""
    names = {k: f"f{i}" for i, k in enumerate(flags)}
    inner = judged.select(F.struct(*judged.columns).alias("r"), *_group(key), F.col(row).alias("p"), "decision", "lender", *[F.coalesce(F.col(c), F.lit(0)).alias(names[k]) for k, c in flags.items()])
    sums = staged(inner.filter("i is not null").groupBy("g", "h", "i").agg(*[F.max(n).alias(n) for n in names.values()], F.max("lender").alias("lender")), "sums")
    own = sums.toDF("g1", "h1", "i1", *[f"own_{n}" for n in names.values()], "lent")
    lent = sums.filter("lender is not null").groupBy(F.col("g").alias("g2"), F.col("lender").alias("p2")).agg(*[F.max(n).alias(f"lent_{n}") for n in names.values()])
    out = inner.join(by_rows(own), F.col("g").eqNullSafe(F.col("g1")) & F.col("h").eqNullSafe(F.col("h1")) & F.col("i").eqNullSafe(F.col("i1")), "left")
    out = out.join(by_rows(lent), F.col("g").eqNullSafe(F.col("g2")) & (F.col("p") == F.col("p2")), "left")
    kept = F.col("decision") == "Keep"
    made = {k: F.when(kept, F.least(F.greatest(F.col(n), F.coalesce(f"own_{n}", F.lit(0)), F.coalesce(f"lent_{n}", F.lit(0))), F.lit(1))).otherwise(F.col(n)) for k, n in names.items()}
    return out.select(*[F.col(f"r.{c}") for c in judged.columns if c not in made], *[made[k].alias(k) for k in made])


def survivor_checks(done: DataFrame, key: str, row: str, flags: list[str]) -> DataFrame:
    """One row for each group of competing rows (key, cluster, is_noise): whether each flag's sum over the dropped rows and
    over the kept ones is 0 or 1, whether no flag's sum over both is 1 (what was dropped is on the kept row), whether
    coordinates lacked, and whether one row is kept. A borrowed row counts as kept in the group that borrowed it."""
    names = [f"f{i}" for i in range(len(flags))]
    facts = [*[F.col(c).alias(n) for c, n in zip(flags, names, strict=True)], (F.col("decision") == "Keep").alias("kept")]
    rows = done.filter("is_noise is not null").select(*_group(key), *facts, F.col("problem_geo").alias("lacks"))
    asks = done.filter("lender is not null").select(*_group(key), F.col("lender").alias("of"), F.col("problem_geo").alias("lacks"))
    lenders = done.select(F.col(key).alias("lg"), F.col(row).alias("p"), *facts)
    lent = asks.join(by_rows(lenders), F.col("g").eqNullSafe(F.col("lg")) & (F.col("of") == F.col("p"))).select("g", "h", "i", *names, "kept", "lacks")
    rows = rows.unionByName(lent.filter("kept"))
    sums = [F.coalesce(F.sum(F.when(F.col("kept") if k else ~F.col("kept"), F.col(c))), F.lit(0)).alias(f"{c}_{k}") for c in names for k in (0, 1)]
    out = rows.groupBy("g", "h", "i").agg(*sums, F.max("lacks").alias("geo_na"), (F.count_if("kept") == 1).alias("one_kept"))
    every = lambda k: F.forall(F.array(*[f"{c}_{k}" for c in names]), lambda s: s.isin(0, 1))
    total = F.forall(F.array(*[F.col(f"{c}_0") + F.col(f"{c}_1") for c in names]), lambda s: s != 1)
    return out.select(F.col("g").alias(key), F.col("h").alias("cluster"), F.col("i").alias("is_noise"), every(0).alias("dropped_all_1"), every(1).alias("kept_all_1"), total.alias("consistent"), "geo_na", "one_kept")


def gap_pairs(years: DataFrame, gap: int) -> DataFrame:
    """(start, end) of all years that lie `gap` apart; a gap of 0 or less has none."""
    a, b = years.select(F.col("year").alias("start")), years.select(F.col("year").alias("end"))
    return a.join(b, F.col("end") == F.col("start") + gap).filter(F.lit(gap) > 0)
