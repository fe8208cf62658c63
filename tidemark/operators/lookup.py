"""Lookups against reference tables, and validation in ordered attempts."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalise_address, zip5, zip_candidates
from ..sources.tables import keep_first


def zip_city_lookup(cities: DataFrame) -> DataFrame:
    """(zip, city, state_id), one row a ZIP, from cities (city, state_id, zips) in the order of city and state."""
    each = cities.select("city", "state_id", F.explode(F.split(F.trim("zips"), r"\s+")).alias("raw"))
    each = each.withColumn("zip", F.regexp_extract("raw", r"\d{5}", 0)).filter("zip <> ''")
    return keep_first(each.select("zip", "city", "state_id"), ["zip"], ["city", "state_id"])


def names_of(codes: DataFrame, row: str, code: str, place: str, lookup: DataFrame, name: str, rows: DataFrame | None = None) -> DataFrame:
    """(row, info): the distinct names of each row's codes, upper case, in the order of `place`; a message with the codes
    if none has a name. With rows, each of these is in the result; one without codes has a message alone."""
    found = codes.join(lookup.select(F.col(code), F.upper(name).alias("_name")), code, "left")
    firsts = found.groupBy(row, "_name").agg(F.min(place).alias("_at"))
    names = F.transform(F.array_sort(F.collect_list(F.when(F.col("_name").isNotNull(), F.struct("_at", "_name")))), lambda s: s["_name"])
    tried = F.transform(F.array_sort(F.collect_list(F.struct(place, F.col(code).cast("string").alias("c")))), lambda s: s["c"])
    out = firsts.groupBy(row).agg(names.alias("n")).join(found.groupBy(row).agg(tried.alias("t")), row)
    out = out.select(row, F.when(F.size("n") > 0, F.array_join("n", ", ")).otherwise(F.concat(F.lit("No Matches Found: "), F.array_join("t", ", "))).alias("info"))
    return out if rows is None else rows.select(row).distinct().join(out, row, "left").withColumn("info", F.coalesce("info", F.lit("No Matches Found")))


class Validator(Protocol):
    """Looks up attempts (row, attempt, key): rows of (row, attempt, answer) for those that are found."""

    def __call__(self, attempts: DataFrame) -> DataFrame: ...


def table_validator(reference: DataFrame, key: str, answer: str) -> Validator:
    """A validator over a reference table, by a join on the key."""
    rows = reference.select(F.col(key).cast("string").alias("key"), F.col(answer).alias("answer"))
    return lambda attempts: attempts.join(rows, "key").select("row", "attempt", "answer")


def waterfall(df: DataFrame, row: str, attempts: Sequence[Column], validate: Validator, missing: str) -> DataFrame:
    """(row, attempt, answer): the first attempt's answer, in the order given; `missing` where none is found."""
    keys = F.posexplode(F.array(*[a.cast("string") for a in attempts]))
    tried = df.select(F.col(row).alias("row"), keys.alias("attempt", "key")).filter("key is not null").withColumn("attempt", F.col("attempt") + 1)
    best = validate(tried).groupBy("row").agg(F.min(F.struct("attempt", "answer")).alias("b"))
    out = df.select(F.col(row).alias("row")).join(best, "row", "left")
    return out.select(F.col("row").alias(row), F.col("b.attempt").alias("attempt"), F.coalesce("b.answer", F.lit(missing)).alias("answer"))


PLACE = ("line_1", "line_2", "city", "state", "zip")


def address_attempts(df: DataFrame, row: str, lookup: DataFrame) -> DataFrame:
    """(row, attempt, place, line_1, line_2, city, state, zip): what to ask a validator about each row's address, in order.

    1: as it stands. 2: with the city, and ZIP, of each of its ZIP candidates that the lookup (zip, city, state_id) has in
    its state, in the candidates' order. 3: with the two lines swapped, if there is a second one.
    """
    own = df.select(F.col(row).alias("row"), *PLACE)
    first = own.withColumns({"attempt": F.lit(1), "place": F.lit(0)})
    swapped = own.filter("line_2 <> ''").withColumns({"line_1": F.col("line_2"), "line_2": F.col("line_1"), "attempt": F.lit(3), "place": F.lit(0)})
    tried = own.select("row", "line_1", "line_2", "state", F.posexplode(zip_candidates(zip5(F.col("zip")))).alias("place", "code"))
    cities = lookup.select(F.col("zip").alias("code"), F.col("city"), F.col("state_id"))
    second = tried.join(cities, "code").filter("state = state_id").withColumns({"zip": F.col("code"), "attempt": F.lit(2)})
    order = ["row", "attempt", "place", *PLACE]
    return first.select(*order).unionByName(second.select(*order)).unionByName(swapped.select(*order))


def address_validator(reference: DataFrame, answer: str) -> Validator:
    """A validator over a reference table of addresses (line_1, city, state, zip): normalised ones must be equal, and the
    first five digits of the ZIP. Answers of (row, attempt, place)."""
    keys = lambda p: [normalise_address(F.col("line_1")).alias(f"{p}l"), normalise_address(F.col("city")).alias(f"{p}c"), F.upper("state").alias(f"{p}s"), zip5(F.col("zip")).alias(f"{p}z")]
    known = reference.select(*keys("r"), F.col(answer).alias("answer"))

    def validate(attempts: DataFrame) -> DataFrame:
        asked = attempts.select("row", "attempt", "place", *keys("a"))
        return asked.join(known, [F.col(f"a{k}") == F.col(f"r{k}") for k in "lcsz"]).select("row", "attempt", "place", "answer")

    return validate


def validated(df: DataFrame, row: str, lookup: DataFrame, validate: Validator, missing: str) -> DataFrame:
    """(row, attempt, answer): that of the first of a row's `address_attempts` that is found; `missing` where none is."""
    best = validate(address_attempts(df, row, lookup)).groupBy("row").agg(F.min(F.struct("attempt", "place", "answer")).alias("b"))
    out = df.select(F.col(row).alias("own")).join(best, F.col("own") == F.col("row"), "left")
    return out.select(F.col("own").alias(row), F.col("b.attempt").alias("attempt"), F.coalesce("b.answer", F.lit(missing)).alias("answer"))
