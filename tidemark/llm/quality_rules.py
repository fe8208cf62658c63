"""Operator 5, quality rules: thresholds that adapt to each language and source, from mergeable quantile sketches.

A sketch counts a measure's values by the power of GAMMA that they reach, zeros by themselves. So it merges by adding, in
any order, takes values of any scale in a number of bins that grows with the logarithm of their range, and gives every
quantile to a relative error of ERROR; ranks at the bins' borders are exact. It is made per (lang, source), merged into
languages and into the whole corpus; a group of fewer than MIN_ROWS rows takes the thresholds of the next larger one. A document fails where a measure lies beyond its group's fence: the quartile plus
or minus REACH times the quartiles' distance, of which each measure has a least that counts, so that a group that is all alike
rejects nothing for a small difference.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import as_rows, in_slices, stage
from .hashing import STEP, mix

SYMBOLS = "#*$%&|<>"
GAPS = " \t\n\x0b\x0c\r"
#: Measure: (least distance of quartiles that counts, whether low values fail as well).
MEASURES = {"symbol_share": (0.01, False), "repeat_share": (0.05, False), "dup_line_share": (0.1, False), "word_length": (0.5, True)}
#: Relative error of a quantile, and the factor between the borders of a bin; the bin of zeros.
ERROR = 0.01
GAMMA, ZERO = (1 + ERROR) / (1 - ERROR), -(1 << 40)
REACH, MIN_ROWS = 3.0, 100
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def repeat_words(ids: np.ndarray) -> int:
    """Words that lie in a window of three words that the text holds twice or more."""
    if len(ids) < 4:
        return 0
    with np.errstate(over="ignore"):
        w = mix(ids.astype(np.uint64) + STEP)
        code = mix(mix(w[:-2] + STEP) + w[1:-1]) * STEP + w[2:]
    _, back, times = np.unique(code, return_inverse=True, return_counts=True)
    at = np.flatnonzero(times[back] > 1)
    hit = np.zeros(len(ids), bool)
    for k in range(3):
        hit[at + k] = True
    return int(hit.sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The counts of COUNTS; lines are those with a word."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    lines = [x for x in text.split("\n") if x.strip(GAPS)]
    return len(words), len(text) - sum(map(text.count, GAPS)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeat_words(ids), len(lines)


def counted(docs: DataFrame, carry: list[str], text_col: str) -> DataFrame:
    """The columns of carry and the counts of COUNTS, for each row of docs."""
    rows = docs.select(*carry, F.col(text_col).alias("text"))
    schema = pa.schema([(k, pa.int64()) for k in COUNTS])
    ddl = StructType([*rows.select(*carry).schema.fields])
    for k in COUNTS:
        ddl = ddl.add(k, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in in_slices(batches, "text"):
            got = [measure(x) for x in t.column("text").to_pylist()]
            out = as_rows({k: [g[i] for g in got] for i, k in enumerate(COUNTS)}, schema)
            yield pa.RecordBatch.from_arrays([*t.columns[:-1], *out.columns], names=[*t.schema.names[:-1], *schema.names])

    return rows.mapInArrow(run, ddl)


def with_measures(df: DataFrame) -> DataFrame:
    def share(a, b):
        return F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(0.0))

    return df.withColumns({"symbol_share": share("n_symbols", "word_chars"), "repeat_share": share("n_repeat_words", "n_words"), "dup_line_share": share("n_dup_lines", "n_lines"), "word_length": share("word_chars", "n_words")})


def bin_of(x: Column) -> Column:
    """The least power of GAMMA that is not below a measure; measures are not negative."""
    return F.when(x > 0, F.ceil(F.log(x) / math.log(GAMMA)).cast("long")).otherwise(ZERO)


def border(power: Column, zero: Column) -> Column:
    return F.when(zero, 0.0).otherwise(F.pow(F.lit(GAMMA), power.cast("double")))


def sketches(measured: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, measure, bin, n): the sketch of each group. Sums of n merge sketches."""
    bins = [F.struct(F.lit(m).alias("measure"), bin_of(F.col(m)).alias("bin")) for m in MEASURES]
    return measured.select(*keys, F.explode(F.array(*bins)).alias("b")).groupBy(*keys, "b.measure", "b.bin").agg(F.count(F.lit(1)).alias("n"))


def fences(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, rows, fences map<measure, struct<low, high>>) from the sketch of each group."""
    run = Window.partitionBy(*keys, "measure")
    ranked = sketch.withColumn("total", F.sum("n").over(run)).withColumn("upto", F.sum("n").over(run.orderBy("bin")))
    rule = F.create_map(*chain.from_iterable((F.lit(m), F.struct(F.lit(f).alias("floor"), F.lit(low).alias("low"))) for m, (f, low) in MEASURES.items()))
    at = {q: F.min(F.when(F.col("upto") >= q * F.col("total"), F.col("bin"))) for q in (0.25, 0.75)}
    quart = ranked.groupBy(*keys, "measure").agg(at[0.25].alias("q1"), at[0.75].alias("q3"), F.first("total").alias("rows")).withColumn("r", rule[F.col("measure")])
    low, high = border(F.col("q1") - 1, F.col("q1") == ZERO), border(F.col("q3"), F.col("q3") == ZERO)
    reach = REACH * F.greatest(high - low, F.col("r.floor"))
    pair = F.struct(F.when(F.col("r.low"), low - reach).otherwise(float("-inf")).alias("low"), (high + reach).alias("high"))
    return quart.groupBy(*keys).agg(F.max("rows").alias("rows"), F.map_from_entries(F.collect_list(F.struct("measure", pair.alias("fence")))).alias("fences"))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Judge every text by the counts of COUNTS, base rules and adaptive fences.

    Returns one row per row of docs: id_col, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long),
    base_failed (n_words < 50, or 100 * n_repeat_words > 50 * n_words), kept (not base_failed and within all fences of
    its language and source; rows that fail the base rules are not in the sketches).

    Null and empty texts have no words and fail. A null lang or source is a group of its own. Repeated rows and null ids
    keep their own rows. Other columns are ignored, whatever their names. An empty table gives an empty table.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    measured = with_measures(stage(counted(rows, ["id", "lang", "source"], "text"), "counts")).withColumn("base_failed", failed)
    by_source = sketches(measured.filter(~F.col("base_failed")), ["lang", "source"])
    by_source = stage(by_source, "sketch")
    by_lang = by_source.groupBy("lang", "measure", "bin").agg(F.sum("n").alias("n"))
    whole = by_lang.groupBy("measure", "bin").agg(F.sum("n").alias("n")).withColumn("one", F.lit(1))
    levels = fences(by_source, ["lang", "source"]), fences(by_lang, ["lang"]), fences(whole, ["one"])
    s, g, w = (f.toDF(*[c if c in ("lang", "source") else f"{c}_{i}" for c in f.columns]) for i, f in enumerate(levels))
    g = g.withColumnRenamed("lang", "lang_")
    rules = s.join(g, s["lang"].eqNullSafe(g["lang_"])).crossJoin(F.broadcast(w))  # w is one row
    rules = rules.select(F.col("lang").alias("l"), F.col("source").alias("s"), F.when(F.col("rows_0") >= MIN_ROWS, F.col("fences_0")).when(F.col("rows_1") >= MIN_ROWS, F.col("fences_1")).otherwise(F.col("fences_2")).alias("fences"))
    joined = measured.join(rules, measured["lang"].eqNullSafe(rules["l"]) & measured["source"].eqNullSafe(rules["s"]), "left")
    inside = F.lit(True)
    for m in MEASURES:
        f = F.col("fences")[m]
        inside = inside & F.coalesce(F.col(m).between(f["low"], f["high"]), F.lit(True))
    return joined.select(F.col("id").alias(id_col), *COUNTS[:5], "base_failed", (~F.col("base_failed") & inside).alias("kept"))
