"""Types of text columns: inferred from counts, with the cells that do not fit kept aside.

Each cell is of the least kind that holds it: nothing, a whole number, a number, a date, a truth value, or text. A column's
type is the least that holds all its cells' kinds (whole numbers and numbers make numbers, any other mixture text). Digits
after a leading zero are text, since they are a code that a number would lose, such as a ZIP. Kinds are counted in
one pass; counts of parts of a table add up, so the order in which they come plays no part.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What stands for a missing cell, and the forms of the kinds.
MISSING = ("", "NA")
WHOLE, NUMBER = r"^[+-]?(0|[1-9][0-9]{0,17})$", r"^[+-]?(0|[1-9][0-9]*)?\.?[0-9]+([eE][+-]?[0-9]{1,3})?$"
CODE, DATE, TRUTH = r"^0[0-9]+$", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$", r"(?i)^(true|false)$"
#: Type of a column by name, and the kinds of cells that it holds.
TYPES = {"long": ("whole",), "double": ("whole", "number"), "date": ("date",), "boolean": ("truth",)}
KINDS = ("whole", "number", "date", "truth", "text")


def kind_of(x: Column) -> Column:
    """The kind of a cell; null for a missing one."""
    t = F.trim(x)
    known = F.when(t.isNull() | t.isin(*MISSING), None).when(t.rlike(CODE), "text").when(t.rlike(WHOLE), "whole")
    return known.when(t.rlike(NUMBER) & t.try_cast("double").isNotNull(), "number").when(t.rlike(DATE) & t.try_cast("date").isNotNull(), "date").when(t.rlike(TRUTH), "truth").otherwise("text")


def kind_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, whole, number, date, truth, text): how many cells of each kind every column has."""
    rows = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), kind_of(F.col(c)).alias("kind")) for c in columns])).alias("cell"))
    return rows.groupBy("cell.column").agg(*[F.count_if(F.col("cell.kind") == k).alias(k) for k in KINDS])


def inferred(df: DataFrame, columns: Sequence[str], tolerance: float = 0.0) -> dict[str, str]:
    """The type of each column, by name: the least that holds all but a share `tolerance` of its cells. A column of missing
    cells alone, and one that nothing else holds, is string. With a code among its cells a column is string in any case."""
    codes = df.agg(*[F.coalesce(F.bool_or(F.trim(c).rlike(CODE)), F.lit(False)).alias(f"c{i}") for i, c in enumerate(columns)]).first()
    coded = {c: codes[i] for i, c in enumerate(columns)}
    out = {}
    for r in kind_counts(df, columns).collect():  # a row for each column
        all_ = sum(r[k] for k in KINDS)
        fits = [t for t, kinds in TYPES.items() if all_ and not coded[r.column] and all_ - sum(r[k] for k in kinds) <= tolerance * all_]
        out[r.column] = fits[0] if fits else "string"
    return {c: out.get(c, "string") for c in columns}


def typed(df: DataFrame, types: Mapping[str, str], row: str) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects). rows: those of df all of whose cells fit, in these types (long, double, date, boolean or string; texts
    trimmed, missing cells null), other columns as they are. rejects: (row, column, value, reason) of every cell that does not
    fit, several to a row if need be; a row's number is the column `row`. So each row is in one of the two."""
    cells = []
    for c, t in types.items():
        if t != "string":
            kind = kind_of(F.col(c))
            bad = kind.isNotNull() & ~kind.isin(*TYPES[t])
            cells.append(F.when(bad, F.struct(F.lit(c).alias("column"), F.col(c).alias("value"), F.concat(kind, F.lit(f" in a column of type {t}")).alias("reason"))))
    none = F.array().cast("array<struct<column: string, value: string, reason: string>>")
    inner = df.select(F.struct(*df.columns).alias("r"), (F.array_compact(F.array(*cells)) if cells else none).alias("bad"))
    cell = lambda c: F.when(~F.trim(F.col(f"r.{c}")).isin(*MISSING), F.trim(F.col(f"r.{c}")))
    good = inner.filter(F.size("bad") == 0).select(*[cell(c).try_cast(types[c]).alias(c) if c in types else F.col(f"r.{c}").alias(c) for c in df.columns])
    rejects = inner.select(F.col(f"r.{row}").alias("row"), F.explode("bad").alias("b")).select("row", "b.column", "b.value", "b.reason")
    return good, rejects
