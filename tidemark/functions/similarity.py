"""Jaro similarity, which Spark has no function for."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Places of the strings that are compared at once: bounds the memory of a batch.
CELLS = 2_000_000


def _codes(strings: list[str], width: int) -> np.ndarray:
    """A row of code points for each string, with 0 behind its end."""
    return np.frombuffer("".join([x.ljust(width, "\0") for x in strings]).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, width)


def _block(a: list[str], b: list[str]) -> np.ndarray:
    la, lb = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    x, y = _codes(a, max(1, la.max())), _codes(b, max(1, lb.max()))
    reach = np.maximum(np.maximum(la, lb) // 2 - 1, 0)
    rows, at = np.arange(len(a)), np.arange(y.shape[1])
    free = at < lb[:, None]
    mine = np.zeros(x.shape, bool)
    for i in range(x.shape[1]):  # the first free equal character within reach, for all pairs at once
        fits = free & (y == x[:, i : i + 1]) & (np.abs(at - i) <= reach[:, None]) & (i < la)[:, None]
        first = fits.argmax(axis=1)
        mine[:, i] = fits[rows, first]
        free[rows[mine[:, i]], first[mine[:, i]]] = False
    theirs = ~free & (at < lb[:, None])
    m = mine.sum(axis=1)
    k = np.flatnonzero(mine), np.flatnonzero(theirs)  # matched characters in order, pair by pair
    apart = x.ravel()[k[0]] != y.ravel()[k[1]]
    swapped = np.bincount(np.repeat(rows, m), weights=apart, minlength=len(rows)).astype(int) // 2
    with np.errstate(divide="ignore", invalid="ignore"):
        out = (m / la + m / lb + (m - swapped) / m) / 3
    return np.where((la == 0) | (lb == 0), (la == lb).astype(float), np.where(m == 0, 0.0, out))


def jaro(a: list[str], b: list[str]) -> np.ndarray:
    """Plain Jaro similarity of each pair; half-transpositions are rounded down."""
    out, order = np.empty(len(a)), np.argsort([max(len(x), len(y)) for x, y in zip(a, b, strict=True)], kind="stable")
    lo = 0
    while lo < len(order):  # pairs of like length together
        hi = lo + 1
        while hi < len(order) and (hi + 1 - lo) * max(len(a[order[hi]]), len(b[order[hi]])) <= CELLS:
            hi += 1
        at = order[lo:hi]
        out[at] = _block([a[i] for i in at], [b[i] for i in at])
        lo = hi
    return out


def _each(a: pd.Series, b: pd.Series) -> pd.Series:
    known = a.notna().to_numpy() & b.notna().to_numpy()
    out = np.full(len(a), np.nan)
    out[known] = jaro(a[known].tolist(), b[known].tolist())
    return pd.Series(out).where(known)


def jaro_similarity(a: Column | str, b: Column | str) -> Column:
    return F.pandas_udf(_each, "double")(a, b)


#: The characters that a normalised address may have.
ADDRESS_LETTERS = "abcdefghijklmnopqrstuvwxyz0123456789, "


def letter_counts(x: Column) -> Column:
    """How often each of ADDRESS_LETTERS occurs, as an array."""
    return F.array(*[F.length(x) - F.length(F.replace(x, F.lit(c), F.lit(""))) for c in ADDRESS_LETTERS])


def jaro_bound(a: Column, b: Column, counts_a: Column, counts_b: Column) -> Column:
    """An upper bound of the Jaro similarity of two normalised addresses: no more characters match than both have."""
    m = F.aggregate(F.zip_with(counts_a, counts_b, lambda x, y: F.least(x, y)), F.lit(0), lambda s, n: s + n)
    return F.when((F.length(a) == 0) | (F.length(b) == 0), F.lit(1.0)).when(m == 0, F.lit(0.0)).otherwise((m / F.length(a) + m / F.length(b) + 1) / 3)
