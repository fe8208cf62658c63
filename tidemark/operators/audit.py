"""Audits of duplicated ids: which assumption each fits, and how its city names vary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_mailbox, members

#: The assumption of each combination of (place alike, same ZIP, same metadata).
ASSUMPTIONS = {(True, True, True): 1, (True, True, False): 2, (True, False, True): 3, (True, False, False): 4, (False, True, True): 5, (False, False, False): 6, (False, True, False): 7, (False, False, True): 7}


def assumption(near: Column, same_zip: Column, same_rest: Column) -> Column:
    """The number of the assumption that the flags fit; null if one is null."""
    out = F.lit(None).cast("int")
    for (a, b, c), n in ASSUMPTIONS.items():
        out = F.when((near == a) & (same_zip == b) & (same_rest == c), F.lit(n)).otherwise(out)
    return out


def assumption_shares(profile: DataFrame, label: str, boxed: str, all_keys: int) -> DataFrame:
    """For each assumption: its keys, and their share in per cent of the profile's keys, of all keys and, for those with a
    mailbox, of its own keys."""
    total = profile.agg(F.count(F.lit(1)).alias("total"))
    by = profile.groupBy(label).agg(F.count(F.lit(1)).alias("n"), F.count_if(boxed).alias("n_boxed")).crossJoin(total)  # one row
    share = lambda a, b: F.round(100 * F.try_divide(a, b), 2)
    return by.select(label, "n", share(F.col("n"), F.col("total")).alias("of_profile"), share(F.col("n"), F.lit(all_keys)).alias("of_all"), share(F.col("n_boxed"), F.col("n")).alias("boxed"))


def city_variation(rows: DataFrame, key: str, city: str, address: str, labels: DataFrame, preferred: DataFrame) -> DataFrame:
    """How the city names of each key vary, from clusters of them: labels (key, city, cluster) and preferred (key, info:
    the cities of its ZIPs, or a message).

    Returns key, preferred, n_entries, boxed (a mailbox among the addresses), similar and unique (city names in clusters of
    any size, and all of them: in binary order), n_similar_clusters, unique_less_similar, n_suggested (null for a message),
    unique_less_preferred and preferred_in_unique (the preferred text stands in that of the unique names).
    """
    message = F.col("info").rlike("Invalid Zip Code:|No Matches Found")
    entries = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n_entries"), F.bool_or(is_mailbox(F.col(address))).alias("boxed"))
    names = labels.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(city)), ", ").alias("unique"), F.count_distinct("cluster").alias("n_similar_clusters"))
    out = entries.join(names, key, "left").join(preferred.select(key, "info"), key, "left")
    n_unique = F.size(members(F.col("unique")))
    suggested = F.when(~message, F.size(members(F.col("info"))))
    return out.select(
        key, F.col("info").alias("preferred"), "n_entries", "boxed", F.col("unique").alias("similar"), "unique", "n_similar_clusters", (n_unique - F.size(members(F.col("unique")))).alias("unique_less_similar"),
        suggested.alias("n_suggested"), (n_unique - suggested).alias("unique_less_preferred"), F.when(~message, F.contains(F.col("unique"), F.col("info"))).alias("preferred_in_unique"))
