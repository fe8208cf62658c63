"""Operator 2, token counts: pieces are counted once per distinct pre-token and summed over each document's pre-tokens.

The model writes a blank as a mark (U+2581, which it takes for a blank in texts too) at the front of a piece, and no piece
holds that mark, or a line feed, after another character. So no merge crosses such a place, and a text falls into
pre-tokens (blanks and the non-blanks after them, a run of blanks, or a line feed) whose piece counts add up.
`check_model` verifies this on the vocabulary and refuses another model. Pre-tokens of more than LONG characters go by
their digest; their pieces are counted where they stand, once a task as far as it remembers, so that their texts are not
shuffled.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_rows, in_slices, stage

PRE_TOKEN = re.compile(r" *[^ \n]+| +|\n")
#: The most frequent pre-tokens are looked up in a broadcast map, at most this many: some 20 MB whatever the corpus. All
#: others are joined, each of which is less than one in FREQUENT of all occurrences, so no hot one reaches the join.
FREQUENT, CHUNK = 200_000, 300_000
#: Characters of a pre-token that goes as it stands, and pieces of long ones that a task remembers.
LONG, REMEMBERED = 48, 50_000


def check_model(model_path: str) -> None:
    """Raise ValueError unless the pre-tokens above are independent under this model."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    for i in range(sp.get_piece_size()):
        if re.search("[^▁]▁|.\n|\n.", sp.id_to_piece(i)):
            raise ValueError(f"a piece of {model_path} crosses pre-tokens: {sp.id_to_piece(i)!r}")
    if sp.encode("  a ", out_type=str) != sp.encode("  a", out_type=str) + ["▁"]:
        raise ValueError(f"{model_path} does not keep blanks as they stand")


def pre_tokens(text: str) -> list[str]:
    """The pre-tokens of a text with the blank that the model puts in front of it."""
    return PRE_TOKEN.findall(" " + text.replace("\u2581", " ")) if text else []


def key_of(pre: str) -> str:
    """What stands for a pre-token; no pre-token but a lone line feed begins with one."""
    return pre if len(pre) <= LONG else "\n" + xxhash.xxh3_128_hexdigest(pre.encode("utf-8", "surrogatepass"))


def count_pieces(sp, tokens: list[str]) -> list[int]:
    """Pieces of each pre-token. The library adds a blank in front, which stands for a pre-token's own first one; where
    there is none, or nothing else (the library gives an empty text no piece), a line feed holds the added blank off,
    and both are taken away again."""
    held_off = [t[0] != " " or t == " " for t in tokens]
    ids = sp.encode(["\n" + t if h else t[1:] for t, h in zip(tokens, held_off, strict=True)], num_threads=1)
    off = [len(sp.encode("\n")) if h else 0 for h in held_off]
    return [len(x) - o for x, o in zip(ids, off, strict=True)]


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096) -> DataFrame:
    """Tokens of every text under a sentencepiece model, without begin, end or added special tokens.

    Returns one row per row of docs: id_col, n_bytes long (UTF-8), n_tokens long, over_limit boolean (n_tokens > limit).
    Strings of special tokens inside texts are plain text, which is the library's default. Null or empty texts: 0 bytes,
    0 tokens, not over. Null and repeated ids keep their own rows, since rows are told apart by their place in the scan.
    Other columns are ignored, whatever their names. An empty table gives an empty table.
    """
    check_model(model_path)
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema_of_pieces = pa.schema([("pre", pa.string()), ("freq", pa.int64()), ("pieces", pa.int64())])

    def corpus_freqs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        held, long = Counter(), {}

        def out() -> pa.RecordBatch:
            return as_rows({"pre": list(held), "freq": list(held.values()), "pieces": map(long.get, held)}, schema_of_pieces)

        for t in in_slices(batches, "text"):
            for text in t.column("text").to_pylist():
                found = pre_tokens(text)
                if text and len(text) > LONG:
                    keys = {x: key_of(x) for x in found if len(x) > LONG}
                    wide = {k: x for x, k in keys.items() if k not in long}
                    long.update(zip(wide, count_pieces(sp, list(wide.values())), strict=True) if wide else ())
                    found = [keys.get(x, x) for x in found] if keys else found
                held.update(found)
                if len(held) > CHUNK or len(long) > REMEMBERED:
                    yield out()
                    held.clear()
                    long.clear()
        yield out()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        for t in batches:
            pre, done = t.column("pre").to_pylist(), t.column("pieces").to_pylist()
            open_ = [i for i, n in enumerate(done) if n is None]
            for i, n in zip(open_, count_pieces(sp, [pre[i] for i in open_]) if open_ else (), strict=True):
                done[i] = n
            yield as_rows({"pre": pre, "freq": t.column("freq"), "pieces": done}, schema_of_pieces)

    ddl = "pre string, freq long, pieces long"
    freqs = rows.select("text").mapInArrow(corpus_freqs, ddl).groupBy("pre").agg(F.sum("freq").alias("freq"), F.max("pieces").alias("pieces"))
    known = stage(freqs.mapInArrow(pieces, ddl), "pieces")
    frequent = known.orderBy(F.desc("freq"), "pre").limit(FREQUENT)
    lookup = spark.sparkContext.broadcast({r.pre: r.pieces for r in frequent.select("pre", "pieces").toLocalIterator()})

    id_type = rows.select("id").schema[0].dataType
    rest = pa.list_(pa.struct([("pre", pa.string()), ("freq", pa.int64())]))
    schema = pa.schema([("row", pa.int64()), ("n_bytes", pa.int64()), ("seen", pa.int64()), ("rest", rest)])

    def per_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, of = TaskContext.get().partitionId() << 40, lookup.value.get
        for t in in_slices(batches, "text"):
            texts = t.column("text").to_pylist()
            seen, other = [], []
            for text in texts:
                total, odd = 0, []
                for pre, n in Counter(pre_tokens(text)).items():
                    if len(pre) > LONG:
                        pre = key_of(pre)
                    if (k := of(pre)) is None:
                        odd.append({"pre": pre, "freq": n})
                    else:
                        total += k * n
                seen.append(total)
                other.append(odd)
            out = as_rows({"row": range(at, at + len(texts)), "n_bytes": [len(x.encode()) if x else 0 for x in texts], "seen": seen, "rest": other}, schema)
            at += len(texts)
            yield pa.RecordBatch.from_arrays([t.column("id"), *out.columns], names=["id", *schema.names])

    ddl = f"id {id_type.simpleString()}, row long, n_bytes long, seen long, rest array<struct<pre: string, freq: long>>"
    by_row = rows.mapInArrow(per_document, ddl).select("id", "row", "n_bytes", "seen", F.explode_outer("rest").alias("r"))
    by_row = by_row.select("id", "row", "n_bytes", "seen", F.col("r.pre").alias("pre"), F.col("r.freq").alias("times"))
    joined = by_row.join(known.select("pre", "pieces"), "pre", "left")
    total = F.first("seen") + F.sum(F.coalesce(F.col("times") * F.col("pieces"), F.lit(0)))
    out = joined.groupBy("row").agg(F.first("id").alias("id"), F.first("n_bytes").alias("n_bytes"), total.alias("n_tokens"))
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
