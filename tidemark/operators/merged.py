"""The consolidated table with all its facts: addresses, coordinates, codes, the split by geography, and its invariants."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.nulls import strict_max, strict_mean, strict_min
from ..functions.text import or_none_given, strip_prefix
from ..sources.tables import staged, unstaged
from .clusters import clusters

NONE_GIVEN, NONE_LISTED = "None Given", "None listed"


@dataclass(frozen=True)
class Columns:
    """The columns of the raw table by what they hold; order numbers its rows, code begins with prefix."""

    key: str
    line: str
    city: str
    state: str
    zip: str
    longitude: str
    latitude: str
    code: str
    established: str
    order: str
    prefix: str = ""


_PLACE = ("address_line_1", "city", "state", "zipcode")
FACTS = (*_PLACE, "compiled_address", "lonlat_test", "latitude", "longitude", "year_established", "code", "extra_code")


def _listed(df: DataFrame, value: Column, place: Column, into: str) -> DataFrame:
    """(k, into): the key's distinct values that are not null, joined in the order of the least place of each."""
    firsts = df.groupBy("k", value.alias("v")).agg(F.min(place).alias("at")).filter("v is not null")
    return firsts.groupBy(F.col("k").alias(f"of_{into}")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "v"))), lambda s: s["v"]), ", ").alias(into))


def _seeded(df: DataFrame, rows: DataFrame) -> DataFrame:
    """df (k, ..) with what all records of a key share: years of establishment in order, and codes' rests as they appear."""
    years = _listed(rows, F.col("established").cast("string"), F.col("established"), "years")
    rests = _listed(rows, F.col("rest"), F.col("nth"), "rests")
    out = df.join(years, F.col("k").eqNullSafe(F.col("of_years")), "left").join(rests, F.col("k").eqNullSafe(F.col("of_rests")), "left")
    return out.withColumns({"year_established": F.coalesce("years", F.lit(NONE_LISTED)), "extra_code": F.coalesce("rests", F.lit(""))}).drop("of_years", "years", "of_rests", "rests")


def _collapsed(rows: DataFrame, group: Column, flags: list[str], reach: float) -> DataFrame:
    """One row for each (k, group): the least address of its rows, flags' sums, mean coordinates and their range test."""
    near = lambda c: F.abs(strict_max(F.col(c)) - strict_min(F.col(c))) < reach
    out = rows.groupBy("k", group.alias("compiled_address")).agg(
        F.min_by(F.struct(*_PLACE), "compiled").alias("place"), F.count(F.lit(1)).alias("n_rows"), (near("x") & near("y")).alias("lonlat_test"),
        strict_mean(F.col("y")).alias("latitude"), strict_mean(F.col("x")).alias("longitude"), *[F.coalesce(F.sum(f), F.lit(0)).alias(f) for f in flags])
    return out.select("k", "place.*", "compiled_address", "n_rows", "lonlat_test", "latitude", "longitude", *flags)


def _print(condition: Column | None = None, name: str = "all", key: str = "k") -> list[Column]:
    """Metrics of a set of keys, one row each: how many, and two order-free sums of their hashes."""
    one = F.col("one") if condition is None else F.col("one") & condition
    hashed = lambda seed: F.sum(F.when(one, F.xxhash64(F.col(key), F.col(key).isNull(), F.lit(seed)).cast("decimal(38,0)")))
    return [F.count_if(one).alias(f"{name}_n"), hashed(1).alias(f"{name}_a"), hashed(2).alias(f"{name}_b")]


def _seen(found: dict, name: str) -> tuple:
    return found[f"{name}_n"] or 0, found[f"{name}_a"] or 0, found[f"{name}_b"] or 0


def _plus(a: tuple, b: tuple, sign: int = 1) -> tuple:
    return tuple(x + sign * y for x, y in zip(a, b, strict=True))


def merged(df: DataFrame, at: Columns, flags: Mapping[str, Column], threshold: float, reach: float) -> tuple[DataFrame, DataFrame]:
    """(table, checks): the consolidated table, written, and one row of checks of it.

    table: key, FACTS, the flags, n_rows, same_num_clusters and status. Keys with several rows are clustered by their
    compiled address (line, city, state, ZIP; a null line is None Given) and collapsed: the cluster's least address, the
    means of both coordinates (null if one lacks), whether their ranges are below reach (lonlat_test; null if unknown), the
    key's years and rests of codes. The split by geography: where a cluster of a key fails the test, the key's numbers of
    exact and similar addresses are compared (same_num_clusters). If they are equal the addresses themselves are duplicates,
    and the failure is overridden (status Overridden); else the failed clusters are given up for their exact addresses, a
    single row without a test (status Expanded). Keys of one row stay as they are, without status. All rows of a key that
    has a row without an address are left out. A null key is a key.

    checks: a, the keys of the collapsed part are those of several rows; b, the parts together
    have as many keys as the raw table, so none is in both; c, both parts have
    all raw keys; d, the final keys are the raw ones less those without an address; e, the raw keys that are gone are
    those without an address; rows_before, rows_after, keys_before, reduction in per cent. Sets of keys are compared by
    their number and two sums of hashes that were observed while the tables were written; nothing is scanned again.
    """
    names = list(flags)
    told = lambda c: F.col(c)
    rows = df.select(told(at.key).alias("k"), or_none_given(told(at.line)).alias("address_line_1"), told(at.city).alias("city"), told(at.state).alias("state"), told(at.zip).alias("zipcode"),
                     told(at.longitude).cast("double").alias("x"), told(at.latitude).cast("double").alias("y"), strip_prefix(told(at.code).cast("string"), at.prefix).alias("rest"), told(at.established).alias("established"), told(at.order).alias("nth"), *[f.alias(k) for k, f in flags.items()])
    rows = rows.withColumn("compiled", F.concat_ws(", ", *_PLACE))
    seen = {n: Observation(n) for n in ("keys", "double", "single", "final")}
    keys = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.bool_or(F.col("address_line_1") == NONE_GIVEN).alias("lacks")).withColumn("one", F.lit(True))
    many, lacks = F.col("n") > 1, F.col("lacks")
    keys = staged(keys.observe(seen["keys"], F.sum("n").alias("rows"), *_print(), *_print(many, "many"), *_print(lacks, "lacks"), *_print(~lacks, "kept")), "keys")
    parted = staged(rows.join(keys.select(F.col("k").alias("of"), "n", "lacks"), F.col("k").eqNullSafe(F.col("of"))).drop("of"), "parted")
    double = parted.filter("n > 1")
    labels = staged(clusters(double.select("k", "compiled"), "k", "compiled", threshold), "labels")
    of = labels.toDF("g", "v", "cluster")
    double = staged(double.join(of, F.col("k").eqNullSafe(F.col("g")) & (F.col("compiled") == F.col("v"))).drop("g", "v"), "double")
    whole = staged(_collapsed(double, F.col("cluster"), names, reach), "collapsed")
    failed_keys = whole.filter("not lonlat_test").select(F.col("k").alias("g")).distinct()
    counts = labels.join(failed_keys, F.col("k").eqNullSafe(F.col("g"))).groupBy(F.col("k").alias("g")).agg((F.count(F.lit(1)) == F.count_distinct("cluster")).alias("same_num_clusters"))
    split = staged(whole.join(counts, F.col("k").eqNullSafe(F.col("g")), "left").drop("g"), "split")
    fails, exact = ~F.coalesce("lonlat_test", F.lit(True)), F.coalesce("same_num_clusters", F.lit(False))
    status = F.when(fails & exact, "Overridden").otherwise(F.upper(F.col("lonlat_test").cast("string")))
    gone = split.filter(fails & ~exact).select(F.col("k").alias("g"), F.col("compiled_address").alias("h"))
    again = double.join(gone, F.col("k").eqNullSafe(F.col("g")) & (F.col("cluster") == F.col("h")), "left_semi")
    again = _collapsed(again, F.col("compiled"), names, reach).withColumn("lonlat_test", F.when(F.col("n_rows") > 1, F.col("lonlat_test")))
    both = split.filter(~(fails & ~exact)).withColumn("status", status).unionByName(again.withColumns({"same_num_clusters": F.lit(False), "status": F.lit("Expanded")}))
    # one row of each key stands for it: that of the least address
    least = both.groupBy(F.col("k").alias("g")).agg(F.min("compiled_address").alias("least"))
    both = _seeded(both.join(least, F.col("k").eqNullSafe(F.col("g"))).withColumn("one", F.col("compiled_address") == F.col("least")).drop("g", "least"), double)
    both = staged(both.observe(seen["double"], *_print(name="double")), "both")
    alone = _seeded(_collapsed(parted.filter("n = 1"), F.col("compiled"), names, reach), parted.filter("n = 1"))
    alone = alone.withColumns({"lonlat_test": F.lit(None).cast("boolean"), "same_num_clusters": F.lit(None).cast("boolean"), "status": F.lit(None).cast("string"), "one": F.lit(True)})
    alone = staged(alone.observe(seen["single"], *_print(name="single")), "alone")
    final = both.unionByName(alone).join(keys.filter("lacks").select(F.col("k").alias("of")), F.col("k").eqNullSafe(F.col("of")), "left_anti")
    final = final.observe(seen["final"], F.count(F.lit(1)).alias("rows"), *_print(name="final")).withColumn("code", F.lit(at.prefix))
    table = staged(final.select(F.col("k").alias(at.key), *FACTS, *names, "n_rows", "same_num_clusters", "status"), "merged")
    spark, found = df.sparkSession, {n: o.get for n, o in seen.items()}
    raw, several, lacking, kept = (_seen(found["keys"], n) for n in ("all", "many", "lacks", "kept"))
    first, second, last = _seen(found["double"], "double"), _seen(found["single"], "single"), _seen(found["final"], "final")
    checks = {
        "a": first == several, "b": first[0] + second[0] == raw[0], "c": _plus(first, second) == raw, "d": last == kept, "e": _plus(raw, last, -1) == lacking,
        "rows_before": found["keys"]["rows"] or 0, "rows_after": found["final"]["rows"] or 0, "keys_before": raw[0]}
    checks["reduction"] = round(100 * (1 - checks["rows_after"] / checks["rows_before"]), 2) if checks["rows_before"] else None
    unstaged(keys, parted, labels, double, whole, split, both, alone)
    return table, spark.createDataFrame([tuple(checks.values())], "a boolean, b boolean, c boolean, d boolean, e boolean, rows_before long, rows_after long, keys_before long, reduction double")
