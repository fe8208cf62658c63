"""Operator 10, sharding by sampled splitters, with DataFrame functions only.

Rows are ordered by a hash of their text, so equal texts lie side by side. A size-weighted sample of these keys gives
quantile boundaries of ranges, LEAST_RANGES or as many as leave each RANGE_BYTES of texts, MOST_RANGES at most; rows are
dealt into ranges, and ranges' sizes are summed. Texts stay out of all this and are joined to their places in the end. Copies of one text that
together hold more than a WHOLE-th part of a shard would overfill a range; there are at most WHOLE * shards such texts.
Each gets cells of its own, as small as a range, into which its rows are dealt by a hash of the row, and goes as a whole
into the shard that has most room, largest first; only if its copies hold more than a shard their cells fill several. What
room the shards have left is filled by the order of the other keys: a range's start and a running sum inside it give each
row's place, so a shard is a stretch of that order, and no range is larger than a small part of a shard. The law is
`bytes`: shards have nearly equal sizes, as far as texts larger than a shard and whole groups allow it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

#: A range is sorted in one task, without its texts. A range's bounds, and a row for each, pass through the driver.
LEAST_RANGES, MOST_RANGES, RANGE_BYTES = 1024, 16_384, 1 << 30
SAMPLE_PER_RANGE, WHOLE = 64, 50


def n_ranges(total: int) -> int:
    return min(max(LEAST_RANGES, -(-total // RANGE_BYTES)), MOST_RANGES)


def splitters(rows: DataFrame, total: int, seed: int) -> list[int]:
    """Boundaries of the ranges: quantiles of a sample of keys, each drawn with a chance in proportion to its size."""
    ranges = n_ranges(total)
    rate = ranges * SAMPLE_PER_RANGE / max(total, 1)
    chance = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "key", "sub"), 11) / float(1 << 53)
    drawn = rows.filter(chance < F.col("size") * rate)
    at = [i / ranges for i in range(1, ranges)]
    found = drawn.agg(F.percentile_approx("key", F.lit(at), F.lit(20 * ranges)).alias("b")).first().b
    return sorted(set(found or []))


def filled(loads: list[float], rest: float) -> list[float]:
    """What each shard gets of `rest` so that the least loaded ones rise to a common level."""
    level, ordered = 0.0, sorted(loads)
    for k, load in enumerate(ordered, 1):
        level = (rest + sum(ordered[:k])) / k
        if k == len(ordered) or level <= ordered[k]:
            break
    return [max(0.0, level - x) for x in loads]


def shard(docs: DataFrame, shards: int = 16, seed: int = 5, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """Put all rows into shards 0 to shards - 1 of nearly equal bytes.

    Returns one row per row of docs: id_col, size long (UTF-8 bytes of the text plus 1), text_crc32 long, law ('bytes'),
    shard int, slot long (gapless from 0 in each shard), grown_shard int (null under this law), then the columns named
    in carry. Rows of equal texts lie in one shard, unless they hold more bytes than a shard.

    Null text: size 1, crc32 of no bytes (0), as for an empty text. Null ids and repeated rows have a shard and slot of
    their own. A row larger than a shard leaves shards empty. Other columns are ignored, whatever their names. An empty
    table gives an empty table.
    """
    if shards < 1:
        raise ValueError("no shards")
    spark = docs.sparkSession
    text, kept = F.coalesce(F.col(text_col), F.lit("")), [f"c{i}" for i in range(len(carry))]
    rows = docs.select(F.col(id_col).alias("id"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)], (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.xxhash64(text).alias("key"), F.monotonically_increasing_id().alias("row"))
    rows = stage(rows.withColumn("sub", F.xxhash64("id", "row")), "rows")
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("t")).first().t
    mean, cell = max(total / shards, 1), max(total / n_ranges(total), 1)
    heavy = rows.groupBy("key").agg(F.sum("size").alias("bytes")).filter(F.col("bytes") > mean / WHOLE)  # at most WHOLE * shards rows
    heavy = heavy.select("key", F.ceil(F.col("bytes") / cell).alias("cells"))
    cuts = splitters(rows, total, seed)
    low, high = -(1 << 63), (1 << 63) - 1
    shift = 64 - (n_ranges(total) - 1).bit_length() - 2  # prefixes of keys, four a range
    edges = [low, *cuts, high]
    table = [(p, i, a, b) for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False)) for p in range(a >> shift, (b >> shift) + 1)]  # a row for each range and prefix
    ranges = spark.createDataFrame(table, "prefix long, range int, above long, upto long")
    dealt = rows.drop(*kept).withColumn("prefix", F.shiftright("key", shift)).join(F.broadcast(ranges), "prefix").filter(((F.col("key") > F.col("above")) | (F.col("key") == low) & (F.col("range") == 0)) & (F.col("key") <= F.col("upto")))
    dealt = dealt.join(F.broadcast(heavy.withColumnRenamed("key", "own")), F.col("key") == F.col("own"), "left")
    within = F.when(F.col("own").isNotNull(), F.pmod(F.xxhash64("sub", F.lit(seed)), "cells") + 1).otherwise(0)  # 0 for keys that are not heavy
    dealt = dealt.withColumns({"own": F.coalesce("own", F.lit(low)), "cell": within}).drop("prefix", "above", "upto", "cells")
    place = ["range", "own", "cell"]
    sums = dealt.groupBy(*place).agg(F.sum("size").alias("bytes")).orderBy(*place).collect()  # the ranges and cells, whose number is bounded
    loads, groups, at_shard = [0.0] * shards, {}, {}
    for r in sums:
        if r.cell:
            groups.setdefault(r.own, []).append(r)
    for group in sorted(groups.values(), key=lambda g: (-sum(r.bytes for r in g), g[0].own)):
        to = loads.index(min(loads))
        cut = sum(r.bytes for r in group) > mean
        for r in group:
            if cut and loads[to] >= mean:
                to = loads.index(min(loads))
            at_shard[r.own, r.cell] = to
            loads[to] += r.bytes
    bounds, start, starts = [], 0.0, []
    for room in filled(loads, sum(r.bytes for r in sums if not r.cell)):
        bounds.append(start := start + room)
    before = 0
    for r in sums:
        starts.append((*[r[c] for c in place], before, at_shard.get((r.own, r.cell))))
        before += 0 if r.cell else r.bytes
    starts = spark.createDataFrame(starts, "range int, own long, cell long, b0 long, at int")
    inside = Window.partitionBy(*place)
    run = inside.orderBy("key", "sub", "row").rowsBetween(Window.unboundedPreceding, 0)
    at = dealt.withColumn("cum", F.sum("size").over(run)).withColumn("nth", F.row_number().over(inside.orderBy("key", "sub", "row")))
    group = Window.partitionBy(*place, "key")
    middle = (F.min(F.col("cum") - F.col("size")).over(group) + F.max("cum").over(group)) / 2
    at = at.withColumn("middle", middle).join(F.broadcast(starts), place)
    stretch = F.size(F.filter(F.array(*[F.lit(float(b)) for b in bounds[:-1]]).cast("array<double>"), lambda b: b <= F.col("b0") + F.col("middle")))
    at = at.withColumn("shard", F.coalesce("at", stretch).cast("int"))
    at = stage(at.select("id", "row", "size", "text_crc32", "shard", "nth", *place), "placed")
    ends = at.groupBy("shard", *place).agg(F.min("nth").alias("first"), F.count(F.lit(1)).alias("n"))  # a row for each range, and one for each border of shards
    earlier = Window.partitionBy("shard").orderBy(*place).rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("shard", *place, (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"))
    out = at.join(F.broadcast(ends), ["shard", *place])
    if carry:
        out = out.join(rows.select("row", *kept), "row")
    return out.select(F.col("id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("nth") + F.col("shift")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), *[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)])
