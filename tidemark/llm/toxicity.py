"""Operator 3, toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the mean of the vectors of its character n-grams (3 to 6, with word ends marked, hashed into a fixed number of
buckets), so a misspelling shares most of its vector with the word that it hides. A window of words is the mean of its
words. A document is judged by its worst window, because a long text can hold one short insult: its score is the softmax
output of the window with the highest logit. Windows overlap by half, and cover the whole text.

The fit reads a bounded sample of the labelled rows (PER_CLASS rows, by hash order); scoring reads all.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Fixed sizes of the model.
BUCKETS, DIM, WINDOW, GRAMS = 1 << 17, 8, 12, (3, 4, 5, 6)
#: Bounds of the training sample: clean and toxic rows, and bytes of a text (longer ones are scored, not learnt from).
PER_CLASS, SAMPLE_BYTES = (4_000, 1_500), 20_000
#: Passes over the sample (more over a small one, for STEPS batches in all), step size and seed.
EPOCHS, STEPS, RATE, SEED = 15, 300, 0.2, 7
#: Characters that are scored at once, and the logit of a text without words, before the bias.
BLOCK, EMPTY = 200_000, -4.0
#: Words are runs of letters and digits, which is what str.isalnum and these patterns agree on.
WORD, NO_WORD = re.compile(r"[^\W_]+"), re.compile(r"[\W_]")


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


@lru_cache(1)
def letters() -> np.ndarray:
    """Whether a code point belongs to a word."""
    return np.array([chr(i).isalnum() for i in range(0x110000)])


def code_points(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The text's code points, with every one outside a word as 0, and where words begin. One 0 stands at either end."""
    c = np.frombuffer(f"\0{text.lower()}\0".encode("utf-32-le", "surrogatepass"), np.uint32)
    word = letters()[c]
    return np.where(word, c, 0).astype(np.uint32), np.flatnonzero(word[1:] & ~word[:-1]) + 1


def grams(c: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of GRAMS, where grams lie within a word and its two ends (the place after a gram's first), and
    their buckets."""
    outside = np.r_[0, np.cumsum(c == 0, dtype=np.int32)]
    odd = [np.uint32(0x9E3779B1 * (2 * k + 1) & 0xFFFFFFFF) for k in range(max(GRAMS))]
    with np.errstate(over="ignore"):
        for n in GRAMS:
            rows = len(c) - n + 1
            if rows <= 0:
                continue
            at = np.flatnonzero(outside[n - 1 : n - 1 + rows] == outside[1 : 1 + rows])  # all between the ends are letters
            acc = np.full(len(at), n, np.uint32)
            for k in range(n):
                acc = (acc ^ (c[at + k] * odd[k])) * np.uint32(0x85EBCA6B)
                acc ^= acc >> np.uint32(15)
            yield at + 1, (acc & np.uint32(BUCKETS - 1)).astype(np.int32)


def windows(scores: np.ndarray, width: int = WINDOW) -> np.ndarray:
    """Mean of the words' scores in every window of `width` words, half overlapping, the last one ending the text."""
    if len(scores) <= width:
        return scores.mean(keepdims=True, axis=0)
    start = np.unique(np.r_[np.arange(0, len(scores) - width, width // 2), len(scores) - width])
    total = np.concatenate([np.zeros((1, *scores.shape[1:])), np.cumsum(scores, axis=0)])
    return (total[start + width] - total[start]) / width


def bags_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all words' grams, one word after the other, and how many each has."""
    flat, sizes = [], []
    for lo in range(0, len(words), 20_000):
        c, begin = code_points(" ".join(words[lo : lo + 20_000]))
        at, bucket = (np.concatenate(x) for x in zip(*grams(c), strict=True))
        own = np.searchsorted(begin, at, "right") - 1
        flat.append(bucket[np.argsort(own, kind="stable")])
        sizes.append(np.bincount(own, minlength=len(begin)))
    return np.concatenate(flat), np.concatenate(sizes)


def worst_window(doc: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The words of the window with the highest logit."""
    if len(doc) <= WINDOW:
        return doc
    best = int(np.argmax(windows(word[doc])))
    start = min(best * (WINDOW // 2), len(doc) - WINDOW)
    return doc[start : start + WINDOW]


class Model:
    """E: a vector for each bucket; W, b: the linear softmax over (clean, toxic)."""

    def __init__(self, seed: int = SEED) -> None:
        rng = np.random.default_rng(seed)
        self.E = rng.uniform(-1, 1, (BUCKETS, DIM)).astype(np.float32) / DIM
        self.W = np.zeros((DIM, 2), np.float32)
        self.W[:, 1] = 0.1
        self.b = np.zeros(2, np.float32)

    def fit(self, texts: list[str], labels: list[int], rate: float = RATE) -> "Model":
        """Batches of documents, each by its worst window as it stands; gradients reach the softmax and the vectors."""
        vocabulary: dict[str, int] = {}
        docs = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words_of(t)], np.int64) for t in texts]
        keep = [i for i, d in enumerate(docs) if len(d)]
        if not keep or len({labels[i] for i in keep}) < 2:
            return self
        flat, sizes = bags_of(list(vocabulary))
        begin = np.cumsum(sizes) - sizes
        share = {k: (len(keep) / (2 * sum(labels[i] == k for i in keep))) ** 0.5 for k in (0, 1)}
        epochs = max(EPOCHS, STEPS * 64 // len(keep))
        rng = np.random.default_rng(SEED)
        past = {id(x): np.zeros_like(x) for x in (self.E, self.W, self.b)}
        for epoch in range(epochs):
            step = rate * (1 - epoch / epochs)
            scalar = self.E @ (self.W[:, 1] - self.W[:, 0])  # a bucket's part of the logit
            word = np.add.reduceat(scalar[flat], begin) / sizes
            order = rng.permutation(keep)
            for batch in np.array_split(order, max(1, len(order) // 64)):
                y = np.array([labels[i] for i in batch])
                found = [worst_window(docs[i], word) for i in batch]
                own = np.repeat(np.arange(len(batch)), [len(d) for d in found])  # the document of each word
                w = np.concatenate(found)
                at = flat[np.repeat(begin[w] - (np.cumsum(sizes[w]) - sizes[w]), sizes[w]) + np.arange(sizes[w].sum())]
                per = np.repeat(own, sizes[w])  # and of each n-gram
                weight = np.repeat(1 / (sizes[w] * np.bincount(own)[own]), sizes[w])[:, None].astype(np.float32)
                vectors = np.add.reduceat(self.E[at] * weight, np.flatnonzero(np.r_[True, per[1:] != per[:-1]]))
                z = vectors @ self.W + self.b
                p = np.exp(z - z.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                p[np.arange(len(y)), y] -= 1
                grad = (p * np.where(y == 1, share[1], share[0])[:, None]).astype(np.float32)
                back = grad @ self.W.T
                touched, back_at = np.unique(at, return_inverse=True)
                slope = np.zeros((len(touched), DIM), np.float32)
                np.add.at(slope, back_at, back[per] * weight)
                for values, rows, g in ((self.E, touched, slope), (self.W, slice(None), vectors.T @ grad), (self.b, slice(None), grad.sum(axis=0))):
                    seen = past[id(values)]  # each value's step shrinks with the slopes that it has seen
                    seen[rows] += g * g
                    values[rows] -= step * g / np.sqrt(seen[rows] + 1e-8)
        return self

    def scorer(self) -> "Scorer":
        """What scoring needs: the logit difference of each bucket (the softmax is linear in the mean) and of the bias."""
        diff = self.W[:, 1] - self.W[:, 0]
        return Scorer((self.E @ diff).astype(np.float32), float(self.b[1] - self.b[0]))


class Scorer:
    """The fitted model as scoring needs it: what each bucket adds to the logit, and the bias."""

    def __init__(self, part: np.ndarray, bias: float) -> None:
        self.part, self.bias = part, bias

    def words(self, text: str) -> np.ndarray:
        """The logit parts of a text's words."""
        c, begin = code_points(text)
        if not len(begin):
            return np.empty(0)
        total, count = np.zeros(len(c), np.float32), np.zeros(len(c), np.float32)
        for at, bucket in grams(c):
            total[at] += self.part[bucket]  # a place has one gram of a length
            count[at] += 1
        return np.add.reduceat(total, begin).astype(float) / np.maximum(np.add.reduceat(count, begin), 1)

    def score(self, texts: list[str | None]) -> list[float]:
        """A text longer than a block is cut where a word ends; texts shorter than one are scored together."""
        out, held, size = [], [], 0
        for text in texts:
            text = text or ""
            if held and len(text) > BLOCK:  # a long text is cut, so it must be alone
                out += self._block(held)
                held, size = [], 0
            held.append(text)
            size += len(text)
            if size > BLOCK:
                out += self._block(held)
                held, size = [], 0
        return out + self._block(held)

    def _block(self, texts: list[str]) -> list[float]:
        if len(texts) == 1 and len(texts[0]) > 2 * BLOCK:
            parts, at = [], 0
            while at < len(texts[0]):
                cut = NO_WORD.search(texts[0], at + BLOCK)
                end = cut.start() if cut else len(texts[0])
                parts.append(self.words(texts[0][at:end]))
                at = max(end, at + 1)
            split = [np.concatenate(parts)]
        else:
            n = [len(words_of(t)) for t in texts]
            split = np.split(self.words("\n".join(texts)), np.cumsum(n)[:-1]) if texts else []
        top = np.array([windows(s).max() if len(s) else EMPTY for s in split])
        return (1 / (1 + np.exp(-np.clip(top + self.bias, -40, 40)))).tolist()


def held_out(id_col: Column, fold: int = 5) -> Column:
    return F.crc32(id_col.cast("string")) % fold == 0


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(id, text, y): at most PER_CLASS texts of the labelled rows in the learning folds, by hash order."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y")).filter(F.col("y").isin(0, 1) & ~held_out(F.col("id")))
    known = known.groupBy("id").agg(F.max("y").alias("y"))
    text = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(F.octet_length("text").between(1, SAMPLE_BYTES))
    # four times the bound, since some labelled rows have no such text
    chosen = reduce(DataFrame.unionByName, [known.filter(F.col("y") == k).orderBy(F.xxhash64("id"), "id").limit(4 * PER_CLASS[k]) for k in (0, 1)])
    both = text.join(F.broadcast(chosen), "id")
    return reduce(DataFrame.unionByName, [both.filter(F.col("y") == k).orderBy(F.xxhash64("id"), "id", "text").limit(PER_CLASS[k]) for k in (0, 1)])


def _fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The scorer of a model fitted to all rows (id, text, y) of a task, in an order that does not depend on theirs."""
    rows = sorted(row for t in batches for row in zip(t.column("y").to_pylist(), t.column("id").to_pylist(), t.column("text").to_pylist(), strict=True))
    scorer = Model().fit([text for _, _, text in rows], [y for y, _, _ in rows]).scorer()
    yield pa.RecordBatch.from_pydict({"part": [scorer.part.tobytes()], "bias": [scorer.bias]})


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Scorer:
    """Fit on the learning folds. Without rows of both classes the model is left as initialised. The fit is one task, whose
    rows PER_CLASS bounds; the driver gets one number for each bucket."""
    sample = training_sample(docs, labels, id_col, text_col, label_col)
    found = sample.coalesce(1).mapInArrow(_fitted, "part binary, bias double").collect()
    return Scorer(np.frombuffer(found[0].part, np.float32), found[0].bias) if found else Model().scorer()


def toxicity(docs: DataFrame, scorer: Scorer, text_col: str = "text", into: str = "score") -> DataFrame:
    """docs with a column `into` (double, 0 to 1, higher: toxic likelier), which replaces one of that name.

    Only the text is an input. Null and empty texts, and those without letters, get the score of a clean text: that of
    the logit -4 and the bias. Rows, repeated or not, keep their place; all other columns pass through as they are.
    """

    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for t in texts:
            yield pd.Series(scorer.score(t.tolist()), dtype=float)

    return docs.withColumn(into, scored(F.col(text_col)))
