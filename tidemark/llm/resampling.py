"""Importance resampling towards a target distribution, over hashed n-grams of words.

A document's features are its runs of 1 to N words, joined by one blank; a feature's bucket is its CRC-32 modulo BUCKETS. The
string of a run is never made: each word's CRC is computed once, and the CRC of a longer run follows from that of the run
without its last word by a GF(2) matrix (crc.py).

Bucket counts are summed in the tasks, one row a bucket and task leaves them, and the gains of all buckets (BUCKETS numbers,
whatever the corpus) go to the tasks that weigh the documents. Draws add Gumbel noise from a digest of the id, so that the
highest scores are a sample without replacement by weight; they are ranked by ranges of the score, in no single task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import with_row_numbers
from .common import as_rows, in_slices, stage
from .crc import SPACE, WordCrcs, joined, shift

BUCKETS = 10_000
N = 3
#: Bytes of one text that are split into words at once.
PIECE = 1_000_000
#: A-Z become a-z, a-z, 0-9 and the bytes of code points beyond ASCII stay, all other bytes part words.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def pieces(text: bytes, most: int = PIECE) -> Iterator[bytes]:
    """The folded text in pieces of about `most` bytes, cut between words."""
    at = 0
    while at < len(text):
        end = at + most
        if end < len(text):
            part = text[at:end].translate(_FOLD)
            while not (cut := part.rfind(b" ") + 1) and end < len(text):
                part += text[end : end + most].translate(_FOLD)
                end += most
            part = part[:cut] if cut else part
        else:
            part = text[at:].translate(_FOLD)
        yield part
        at += len(part)


class Features:
    """Buckets of the n-grams of texts."""

    def __init__(self, buckets: int = BUCKETS, longest: int = N) -> None:
        self.buckets, self.longest, self.crcs = buckets, longest, WordCrcs()

    def of(self, words: list[bytes], own: np.ndarray, lead: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(place of the last word, bucket) of all n-grams of a length, for each length; own is each word's document. The
        first `lead` words are context: they only begin n-grams."""
        packed = np.fromiter(map(self.crcs.__getitem__, words), np.uint64, len(words))
        word, size = packed.astype(np.uint32), (packed >> np.uint64(32)).astype(np.int64)
        spaced = joined(np.full(len(word), SPACE), word, size)  # the word with a blank before it
        run = word
        for n in range(1, self.longest + 1):
            if n > 1:
                run = joined(run[:-1], spaced[n - 1 :], size[n - 1 :] + 1)
            last = np.arange(n - 1, len(word))
            inside = (own[n - 1 :] == own[: len(own) - n + 1]) & (last >= lead)
            yield last[inside], (run[inside] % np.uint32(self.buckets)).astype(np.int64)
            if len(run) < 2:
                return

    def blocks(self, texts: list[bytes | None]) -> Iterator[tuple[list[bytes], np.ndarray, int]]:
        """(words, own, lead) of blocks that cover the texts: short texts share one, a long one has several, each led by
        the last words of the block before."""
        held, own = [], []
        for i, text in enumerate(texts):
            if text is None:
                continue
            if len(text) <= PIECE:
                found = text.translate(_FOLD).split()
                held += found
                own.append(np.full(len(found), i))
                if len(held) >= PIECE // 4:
                    yield held, np.concatenate(own), 0
                    held, own = [], []
                continue
            tail: list[bytes] = []
            for part in pieces(text):
                found = tail + part.split()
                yield found, np.full(len(found), i), len(tail)
                tail = found[max(0, len(found) - self.longest + 1) :]
        if held:
            yield held, np.concatenate(own), 0

    def count(self, texts: list[bytes | None], into: np.ndarray) -> None:
        for words, own, lead in self.blocks(texts):
            for _, bucket in self.of(words, own, lead):
                into += np.bincount(bucket, minlength=self.buckets)

    def weigh(self, texts: list[bytes | None], gains: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words and the sum of gains of each text."""
        n, weight = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        for words, own, lead in self.blocks(texts):
            n += np.bincount(own[lead:], minlength=len(texts))
            gain = np.zeros(len(words), np.int64)
            for last, bucket in self.of(words, own, lead):
                gain[last] += gains[bucket]
            upto = np.concatenate([[0], np.cumsum(gain)])  # integers: exact in any order
            seen, first = np.unique(own, return_index=True)
            weight[seen] += upto[np.append(first[1:], len(own))] - upto[first]
        return n, weight


def _as_bytes(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def bucket_counts(docs: DataFrame, text_col: str = "text", buckets: int = BUCKETS, longest: int = N) -> DataFrame:
    """(bucket, n) of all features of docs. Null texts and texts without words have none."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, total = Features(buckets, longest), np.zeros(buckets, np.int64)
        for t in in_slices(batches, "text"):
            features.count(_as_bytes(t.column("text")), total)
        seen = np.flatnonzero(total)
        yield as_rows({"bucket": seen, "n": total[seen]}, pa.schema([("bucket", pa.int64()), ("n", pa.int64())]))

    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(counted, "bucket long, n long")
    return rows.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, text_col: str = "text", buckets: int = BUCKETS, longest: int = N) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))) of each bucket: s of S features of docs, t of T of target."""
    found = []
    for df in (docs, target):
        n = np.zeros(buckets)
        for row in bucket_counts(df, text_col, buckets, longest).collect():  # `buckets` rows at most
            n[row.bucket] = row.n
        found.append(n)
    source, wanted = found
    ratio = (wanted + 1) * (source.sum() + buckets) / ((source + 1) * (wanted.sum() + buckets))
    return np.array([math.floor(1000 * math.log(x)) for x in ratio], np.int64)


def gumbel(id_col: Column, seed: int) -> Column:
    """1000 times Gumbel noise, rounded down, from the first 32 bits of the SHA-256 of `seed:id`; null without an id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), id_col.cast("string")).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (), buckets: int = BUCKETS, longest: int = N) -> DataFrame:
    """(id, carried columns, n_words, n_features, weight, score, rank) of every row of docs.

    weight is the sum of the gains of a text's features towards the texts of target, score adds the noise of the id, and
    rank is 1, 2, 3 ... for the floor(percent * N / 100) highest scores among the N rows that have an id and at least
    `least_words` words, ties to the smaller id; all other rows have no rank. Repeated rows are rows of their own, told
    apart by weight. Null and empty texts have no features and the weight 0; rows without an id have no score. A carried
    column that has the name of a result is left to the result. Empty docs give an empty table; an empty target leaves
    the gains to the buckets' rarity.
    """
    gains = bucket_gains(docs, target, text_col, buckets, longest)

    @F.pandas_udf("n long, w long")
    def weighed(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        features = Features(buckets, longest)
        for t in texts:
            n, w = features.weigh([x.encode("utf-8", "surrogatepass") if x is not None else None for x in t], gains)
            yield pd.DataFrame({"n": n, "w": w})

    names = {id_col, "n_words", "n_features", "weight", "score", "rank"}
    carried = [c for c in carry if c not in names]
    rows = docs.select(F.col(id_col), *carried, weighed(F.col(text_col)).alias("_found"))
    words = F.col("_found.n")
    features = sum((F.greatest(words - k, F.lit(0)) for k in range(longest)), F.lit(0)).cast("long")
    rows = rows.select(id_col, *carried, words.alias("n_words"), features.alias("n_features"), F.col("_found.w").alias("weight"), (F.col("_found.w") + gumbel(F.col(id_col), seed)).alias("score"))
    rows = stage(rows, "weighed")
    may = F.col("score").isNotNull() & (F.col("n_words") >= least_words)
    drawn = rows.filter(may).count() * percent // 100
    ranked = with_row_numbers(rows.filter(may).withColumn("score", -F.col("score")), ["score", id_col, "weight"], "rank").withColumn("score", -F.col("score"))
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")).cast("long"))
    return ranked.unionByName(rows.filter(~F.coalesce(may, F.lit(False))).withColumn("rank", F.lit(None).cast("long")))
