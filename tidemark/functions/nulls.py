"""Null rules of data frames whose missing values poison aggregates and belong to no set."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_in(x: Column, values: Iterable) -> Column:
    """Set membership that is never null: a null belongs to no set."""
    return F.coalesce(x.isin(*values), F.lit(False))


def not_in(x: Column, values: Iterable) -> Column:
    """The opposite of is_in, so rows with a null are kept."""
    return ~is_in(x, values)


def _all_known(x: Column) -> Column:
    return F.count(x) == F.count(F.lit(1))


def strict_max(x: Column) -> Column:
    """Null if any row of the group is null."""
    return F.when(_all_known(x), F.max(x))


def strict_min(x: Column) -> Column:
    return F.when(_all_known(x), F.min(x))


def strict_mean(x: Column) -> Column:
    return F.when(_all_known(x), F.avg(x))


def strict_sum(x: Column) -> Column:
    return F.when(_all_known(x), F.sum(x))


def one_value(x: Column) -> Column:
    """Whether the group has one value, a null being one; told by its extremes, so that no row is expanded."""
    n = F.count(x)
    return (n == 0) | (n == F.count(F.lit(1))) & F.coalesce(F.min(x) == F.max(x), F.lit(False))


def paste(*parts: Column, sep: str = ", ") -> Column:
    """Joined parts, a null as the letters NA."""
    return F.concat_ws(sep, *[F.coalesce(p.cast("string"), F.lit("NA")) for p in parts])


def join_strict(*parts: Column, sep: str = ", ") -> Column:
    """Joined parts; null if any part is."""
    out = parts[0].cast("string")
    for p in parts[1:]:
        out = F.concat(out, F.lit(sep), p.cast("string"))
    return out
