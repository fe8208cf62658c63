"""Running values over groups of any size: an order that is cut into ranges, with what crosses their borders carried on.

A window over a group puts the group into one task. Here the rows are dealt into ranges of (group, order), so a large group
has many; windows run within a range, and each range's outcome, a row for each group that it shares with others, is carried
to the next. A range shares its first and its last group at most, so what is carried is small and is broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import staged

#: Running values up to and with the row, by an aggregate that can be carried on.
_JOIN = {"sum": lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)), "min": F.least, "max": F.greatest}
_OVER = {"sum": F.sum, "min": F.min, "max": F.max}


def ranged(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """df dealt into ranges of (by, order), written: row struct, part int, k0 .. the group, o0 .. the order.

    The order should tell rows apart: rows that are equal in it stay in one range, in any order. Nulls come first.
    """
    keys, orders = [f"k{i}" for i in range(len(by))], [f"o{i}" for i in range(len(order))]
    rows = df.select(F.struct(*df.columns).alias("row"), *[F.col(c).alias(k) for c, k in zip((*by, *order), (*keys, *orders), strict=True)])
    dealt = rows.repartitionByRange(*keys, *orders) if keys or orders else rows
    return staged(dealt.withColumn("part", F.spark_partition_id()), "ranged")


def scan(rows: DataFrame, values: Mapping[str, tuple[str, Column]]) -> DataFrame:
    """rows (of `ranged`, or of a scan before) with a column for each of values, name: (kind, value).

    kind `sum`, `min`, `max`: of the values of the group's rows up to and with this one; `sum` counts nulls as 0. `least`:
    the minimum from this row on. `prev`, `next`: the value of the row before or after in the group, null at its ends.
    """
    keys, orders = ([c for c in rows.columns if c[0] == x and c[1:].isdigit()] for x in "ko")
    inner = rows.withColumns({f"in_{n}": v for n, (_, v) in values.items()})
    mine = Window.partitionBy("part", *keys).orderBy(*orders)
    upto = mine.rowsBetween(Window.unboundedPreceding, 0)
    onward = Window.partitionBy("part", *keys).orderBy(*[F.desc(o) for o in orders]).rowsBetween(Window.unboundedPreceding, 0)  # a frame to the end would be summed anew for each row
    local, outcome = {"at_first": F.row_number().over(mine) == 1, "at_last": F.lead(F.lit(True)).over(mine).isNull()}, []
    place = F.struct(*orders)
    for n, (kind, _) in values.items():
        v = F.col(f"in_{n}")
        if kind in _OVER:
            local[f"own_{n}"] = _OVER[kind](v).over(upto)
            outcome.append(_OVER[kind](v).alias(f"end_{n}"))
        elif kind == "least":
            local[f"own_{n}"] = F.min(v).over(onward)
            outcome.append(F.min(v).alias(f"end_{n}"))
        else:
            local[f"own_{n}"] = (F.lag if kind == "prev" else F.lead)(v).over(mine)
            outcome.append((F.max_by if kind == "prev" else F.min_by)(v, place).alias(f"end_{n}"))
    ends = inner.groupBy("part", *keys).agg(*outcome)
    line = Window.partitionBy(*keys).orderBy("part")
    before, after = (Window.partitionBy(*keys).orderBy(o).rowsBetween(Window.unboundedPreceding, -1) for o in (F.col("part"), F.desc("part")))
    carried = {"several": F.count(F.lit(1)).over(Window.partitionBy(*keys))}
    for n, (kind, _) in values.items():
        end = F.col(f"end_{n}")
        carried[f"far_{n}"] = _OVER[kind](end).over(before) if kind in _OVER else F.min(end).over(after) if kind == "least" else F.lag(end).over(line) if kind == "prev" else F.lead(end).over(line)
    carry = ends.withColumns(carried).filter("several > 1").select(F.col("part").alias("c_part"), *[F.col(k).alias(f"c_{k}") for k in keys], *[f"far_{n}" for n in values])
    same = F.col("part") == F.col("c_part")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"c_{k}"))
    out = inner.withColumns(local).join(F.broadcast(carry), same, "left")  # two groups a range at most
    made = {}
    for n, (kind, _) in values.items():
        own, far = F.col(f"own_{n}"), F.col(f"far_{n}")
        made[n] = _JOIN[kind](own, far) if kind in _OVER else F.least(own, far) if kind == "least" else F.when(F.col("at_first" if kind == "prev" else "at_last"), far).otherwise(own)
    return out.select(*rows.columns, *[made[n].alias(n) for n in values])
