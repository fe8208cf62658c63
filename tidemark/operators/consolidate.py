"""From duplicated records to one table: clusters of ids with several rows, single rows as they are, and the last checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.presence import first_one
from ..functions.text import or_none_given, pad_zip
from ..sources.tables import staged
from .clusters import clusters, collapse, expand_failed

NONE_GIVEN = "None Given"


def consolidated(df: DataFrame, key: str, value: str, x: str, flags: Mapping[str, Column], threshold: float, reach: float) -> DataFrame:
    """One row for each cluster of similar values of a key: (key, cluster, n_rows, the flags' sums, mean_x, status).

    Keys with one row keep it, with a null status. The others are clustered and collapsed; a cluster whose x range reaches
    `reach` is expanded into its exact values (status Expanded), any other has the outcome of its range test. Null values
    count as None Given. A null x is null in the mean; a range test with one is null, and passes.
    """
    rows = df.withColumn(value, or_none_given(F.col(value)))
    many = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col(key).alias("_many"))
    on = F.col(key).eqNullSafe(F.col("_many"))
    double, single = rows.join(many, on, "left_semi"), rows.join(many, on, "left_anti")
    labels = staged(clusters(double, key, value, threshold), "clusters")
    done = expand_failed(double, key, value, labels, collapse(double, key, value, labels, x, flags, reach), x, flags, reach)
    columns = [key, "cluster", "n_rows", *flags, "mean_x", "status"]
    alone = single.select(key, F.col(value).alias("cluster"), F.lit(1).cast("long").alias("n_rows"), *[F.coalesce(f, F.lit(0)).cast("long").alias(k) for k, f in flags.items()], F.col(x).alias("mean_x"), F.lit(None).cast("string").alias("status"))
    return done.select(*columns).unionByName(alone)


def without_missing(df: DataFrame, key: str, address: str) -> DataFrame:
    """df without all rows of keys that have a row without an address (null or None Given)."""
    lacking = df.filter(F.col(address).isNull() | (F.col(address) == NONE_GIVEN)).select(F.col(key).alias("_lacking")).distinct()
    return df.join(lacking, F.col(key).eqNullSafe(F.col("_lacking")), "left_anti")


def finished(df: DataFrame, key: str, zip_: str, flags: Sequence[str], tie: Sequence[str]) -> DataFrame:
    """df with ZIPs padded, null flags 0 and each row's place within its key, sorted by key and place: rows with the older
    first flag come first, those without any last; `tie` decides among equals."""
    first = first_one({c: F.col(c) for c in flags})
    order = Window.partitionBy(key).orderBy(first.asc_nulls_last(), *tie)
    out = df.withColumn("nth", F.row_number().over(order))
    out = out.withColumns({zip_: pad_zip(F.col(zip_)), **{c: F.coalesce(F.col(c), F.lit(0)) for c in flags}})
    return out.orderBy(F.col(key).asc_nulls_last(), "nth")


def reductions(raw: DataFrame, final: DataFrame, key: str, address: str) -> DataFrame:
    """One row of checks of a consolidation: rows and keys before and after, the reduction of rows in per cent, and how
    many final keys are new (none may be), were dropped for a missing address (none may be left), or have none now."""
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias(f"rows_{name}"), F.count_distinct(key).alias(f"keys_{name}"))
    known = raw.select(F.col(key).alias("_known")).distinct()
    new = final.join(known, F.col(key).eqNullSafe(F.col("_known")), "left_anti").agg(F.count(F.lit(1)).alias("new_keys"))
    missing = final.agg(F.count_if(F.col(address).isNull() | (F.col(address) == NONE_GIVEN)).alias("missing_left"))
    out = count(raw, "before").crossJoin(count(final, "after")).crossJoin(new).crossJoin(missing)  # one row each
    return out.withColumn("reduction", F.round(100 * (1 - F.try_divide("rows_after", "rows_before")), 2))
