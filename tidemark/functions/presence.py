"""Measures of yearly presence, on strings of 0 and 1."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The years that each census stands for.
REFERENCES = (("2000 Census", 2000, 2009), ("2010 Census", 2010, 2019), ("2020 Census", 2020, 2029))


def bits(flags: Sequence[Column]) -> Column:
    return F.concat(*[F.coalesce(f.cast("string"), F.lit("0")) for f in flags])


def first_one(flags: dict[str, Column]) -> Column:
    """Name of the first flag that is exactly 1."""
    return F.coalesce(*[F.when(f == 1, F.lit(k)) for k, f in flags.items()])


def fill_gaps(x: Column) -> Column:
    """Gaps of one to three zeros between ones become ones."""
    for n in (1, 2, 3):
        x = F.regexp_replace(x, f"(?<=1)0{{{n}}}(?=1)", "1" * n)
    return x


def fill_end(x: Column) -> Column:
    """As fill_gaps, and one to three zeros at the end, after a one."""
    for n in (1, 2, 3):
        x = F.regexp_replace(x, f"(?<=1)0{{{n}}}(?=1|$)", "1" * n)
    return x


def fill_start(x: Column) -> Column:
    """Zeros after a one become ones, three, two or one of them, as long as another zero follows: such runs in three
    passes, so a long run of zeros is filled from its start by six at most."""
    for n in (3, 2, 1):
        x = F.regexp_replace(x, f"(?<=1)0{{{n}}}(?=0)", "1" * n)
    return x


def looks_ahead(during: Column, after: Column) -> Column:
    """Whether presence persists beyond a range: open at its last year, or open both within it and after it."""
    return during.endswith("1") | (during.contains("1") & after.contains("1"))


def n_ones(x: Column) -> Column:
    return F.length(F.replace(x, F.lit("0"), F.lit("")))


def persistence(part: Column, whole: Column) -> Column:
    """Share of open years in the part, times the whole's open years by the part's length; 0 where one has none."""
    own, all_ = n_ones(part), n_ones(whole)
    return F.when((own == 0) | (all_ == 0), F.lit(0.0)).otherwise(own / F.length(part) * (all_ / F.length(part)))


def closures(filled: Column) -> Column:
    """Runs of more than three zeros after a one, which end the string or are followed by two ones at least."""
    return F.regexp_count(filled, F.lit("(?<=1)0{4,}(?=11|$)"))


def reopenings(filled: Column) -> Column:
    return F.regexp_count(filled, F.lit("(?<=1)0{4,}(?=11)"))


def reference(start: Column, end: Column, spanning: bool) -> Column:
    """The census of the end year, or the one that shares most years with start to end (the first, on a tie)."""
    if not spanning:
        out = F.lit(None).cast("string")
        for name, lo, hi in REFERENCES:
            out = F.when(end.between(lo, hi), F.lit(name)).otherwise(out)
        return out
    shared = [(name, F.greatest(F.least(end, F.lit(hi)) - F.greatest(start, F.lit(lo)) + 1, F.lit(0))) for name, lo, hi in REFERENCES]
    most = F.greatest(*[s for _, s in shared])
    return F.when(most > 0, F.coalesce(*[F.when(s == most, F.lit(name)) for name, s in shared]))
