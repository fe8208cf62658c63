"""Operator 1, n-gram Jaccard join: documents whose sets of word shingles are similar, by size-banded tiles.

Sizes are cut into bands that grow by half. Two similar sets lie in the same band or in neighbouring ones, so tile t
holds band t and the part of band t + 1 that can still match. Two sets of sizes a and b with 100 * i >= p * u differ in
at most (a + b) * (100 - p) / (100 + p) shingles. A tile deals shingles by hash into more parts than that, so at least
one part holds the same shingles in both sets; its content is the key that brings the pair together. A part may be empty
in both, so a tile has some spare parts, and a set with more empty parts than that posts its empty parts as well: no
similar pair is without a common key. Pairs with a common key are bounded by bitmaps, then intersected exactly
(`setjoin`). Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_rows, in_slices, keys_hint, stage
from .hashing import STEP, WordHashes, fingerprint, mix, word_shingles
from .setjoin import ITEMS_DDL, POSTINGS, POSTINGS_DDL, Combiner, bitmap, buckets_for, item_rows, link, need, overlap

#: Empty parts that a tile allows for, besides a tenth of its parts.
SPARE = 3
#: Sets that a task remembers, so as not to post them again; and bytes of text for each posting, to choose a number of buckets.
SEEN, BYTES_PER_KEY = 200_000, 10


@lru_cache(8)
def tiles(percent: int) -> tuple[np.ndarray, list[int], list[int]]:
    """Each band's least size; each tile's number of parts and of spare parts."""
    lows = [1]
    while lows[-1] < 1 << 40:
        lows.append(max(lows[-1] + 1, -(-lows[-1] * 100 // percent), lows[-1] * 3 // 2))
    parts, spares = [], []
    for low, high in zip(lows[1:], lows[2:], strict=False):
        most = low - 1
        differ = (most + min(most * 100 // percent, high - 1)) * (100 - percent) // (100 + percent)
        spare = differ and differ // 8 + SPARE
        parts.append(differ + 1 + spare)
        spares.append(spare)
    return np.array(lows), parts, spares


def tile_keys(shingles: np.ndarray, percent: int) -> np.ndarray:
    """The keys of a set: the content of its parts, in each tile that it belongs to."""
    n = len(shingles)
    if not n:
        return np.empty(0, np.uint64)
    lows, parts, spares = tiles(percent)
    band = int(np.searchsorted(lows, n, "right")) - 1
    out = []
    with np.errstate(over="ignore"):
        top, content = shingles >> np.uint64(32), mix(shingles + STEP)
        for t in (band, band - 1) if band and n * percent <= 100 * (int(lows[band]) - 1) else (band,):
            part = (top * np.uint64(parts[t])) >> np.uint64(32)  # grows with the hash, and shingles are sorted
            start = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            tag = (part[start] + np.uint64(t) * np.uint64(1 << 40)) * STEP
            out.append(mix(np.add.reduceat(content, start) ^ mix(tag)))
            if parts[t] - len(start) > spares[t]:
                empty = np.setdiff1d(np.arange(parts[t], dtype=np.uint64), part[start], assume_unique=True)
                out.append(mix(mix((empty + np.uint64(t) * np.uint64(1 << 40)) * STEP) + np.uint64(1)))
    return np.concatenate(out)


def jaccard_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80, by_text: bool = False) -> DataFrame:
    """Group documents that are connected by links of similarity >= percent per cent of `width`-word shingles.

    Returns one row per row of docs: id_col, n_shingles long, component_id (smallest id reachable by links, the
    document's own included). Words are [^\\x20\\x09-\\x0D]+ after lower-casing A-Z.

    by_text: with k1 and k2, hashes of the text, and stays boolean: whether the row is the first of its group by id and
    these, or of no group. Where an id has several texts, only this tells their groups apart.

    Null, empty or blank texts: no shingles, linked with nothing, component_id is the id itself. Fewer than `width`
    words: the whole sequence is the one shingle. A row with a null id links nothing and has a null component_id.
    Repeated rows come back as often as they stand in docs. Equal texts under one id count as one. Other columns are
    ignored, whatever their names. An empty table gives an empty table. Length of a text is bounded by memory of one
    task alone.
    """
    extra = {"k1": F.xxhash64(F.col(text_col)), "k2": F.hash(F.col(text_col))} if by_text else {}
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *[c.alias(k) for k, c in extra.items()])
    carried = list(extra)
    place = F.struct("id", *extra) if by_text else F.col("id")
    kind = dict(rows.dtypes)["id"]
    if kind not in ("bigint", "int", "smallint", "tinyint"):
        raise TypeError(f"{id_col} must be an integer, not {kind}")
    rows = rows.withColumn("id", F.col("id").cast("long"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    buckets = buckets_for(size // BYTES_PER_KEY)
    per_row = [("id", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.int64()), ("bits", pa.binary()), *[(k, pa.int64() if k == "k1" else pa.int32()) for k in carried]]
    schema = pa.schema([*per_row, *zip(POSTINGS.names, POSTINGS.types, strict=True)])
    ddl = "id long, n_shingles long, node long, bits binary, " + ("k1 long, k2 int, " if by_text else "") + POSTINGS_DDL

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each row of docs, and rows of postings, which have a bucket. A set is posted once a task, as far as
        the task remembers."""
        cache, seen, out = WordHashes(), set(), Combiner(buckets)

        def widened(t: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([t.column(f.name) if f.name in t.schema.names else pa.nulls(t.num_rows, f.type) for f in schema], schema=schema)

        for t in in_slices(batches, "text"):
            sets = [word_shingles(x, width, cache) for x in t.column("text").to_pylist()]
            ids = t.column("id")
            nodes = [fingerprint(s) if len(s) and i is not None else None for s, i in zip(sets, ids.to_pylist(), strict=True)]
            own = as_rows({"n_shingles": [len(s) for s in sets], "node": nodes, "bits": [None if n is None else bitmap(s) for s, n in zip(sets, nodes, strict=True)]}, pa.schema(per_row[1:4]))
            yield widened(pa.RecordBatch.from_arrays([ids, *own.columns, *[t.column(k) for k in carried]], names=["id", *own.schema.names, *carried]))
            if len(seen) > SEEN:
                seen.clear()
            for s, node in zip(sets, nodes, strict=True):
                if node is not None and node not in seen:
                    seen.add(node)
                    keys = tile_keys(s, percent)
                    out.add(np.full(len(keys), node, np.int64), keys)
                    yield from map(widened, out.batches())
        yield from map(widened, out.batches(last=True))

    def itemised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for t in in_slices(batches, "text"):
            sets = [word_shingles(x, width, cache) for x in t.column("text").to_pylist()]
            yield item_rows([fingerprint(s) for s in sets], sets)

    both = stage(rows.mapInArrow(hashed, ddl), "hashed")
    sizes = both.filter("bucket is null").drop(*POSTINGS.names)
    known = sizes.filter("node is not null").groupBy("node").agg(F.min("id").alias("id"), F.min(place).alias("first"), F.first("n_shingles").alias("n"), F.first("bits").alias("bits"))
    known = stage(known, "nodes")

    def fetch(nodes: DataFrame) -> DataFrame:
        wanted = keys_hint(stage(known.select("node", "id").join(nodes, "node", "left_semi").select("id").distinct(), "wanted"))
        return rows.join(wanted, "id", "left_semi").dropDuplicates(["id", "text"]).select("text").mapInArrow(itemised, ITEMS_DDL)

    roots = link(both.filter("bucket is not null").select(*POSTINGS.names), lambda nodes: known.select("node", "n", "bits"), fetch, percent)
    rooted = known.select("node", "first").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("first").alias("first"))
    by_node = rooted.drop("first").join(least, "root").select("node", "first", F.col("first.id" if by_text else "first").alias("component_id"))
    out = sizes.join(by_node, "node", "left")
    return out.select(F.col("id").cast(kind).alias(id_col), "n_shingles", F.coalesce("component_id", "id").cast(kind).alias("component_id"), *extra, *([F.coalesce(place == F.col("first"), F.lit(True)).alias("stays")] if by_text else []))


def jaccard_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """Every link that `jaccard_groups` groups by: each candidate pair of different sets is intersected exactly, once.

    Returns one row per pair of similar sets: a and b, the least ids of the documents that have them (a's set is that of
    the smaller id), n_a, n_b, common (shingles), links long (pairs of documents that it stands for: ids of one times ids
    of the other). A set of several ids has a row with itself, a = b, and the pairs of these as links. So the sum of links
    is the number of similar pairs of ids. Sets of one id with different texts count as of different ids.

    Rows without id or without words link nothing. Unlike the groups, the result, and the work, grows with the square of
    the number of different sets in a group of near copies; exact copies cost nothing.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).filter("id is not null")
    schema = pa.schema([("id", pa.int64()), ("node", pa.int64()), ("n", pa.int64()), ("items", pa.binary()), ("keys", pa.list_(pa.int64()))])
    pair_schema = pa.schema([(c, pa.int64()) for c in ("x", "y", "common")])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for t in in_slices(batches, "text"):
            sets = [word_shingles(x, width, cache) for x in t.column("text").to_pylist()]
            held = [(i, s) for i, s in zip(t.column("id").to_pylist(), sets, strict=True) if len(s)]
            keys = [np.unique(tile_keys(s, percent)).view(np.int64) for _, s in held]
            yield as_rows({"id": [i for i, _ in held], "node": [fingerprint(s) for _, s in held], "n": [len(s) for _, s in held], "items": [s.tobytes() for _, s in held], "keys": keys}, schema)

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            c = {k: t.column(k).to_pylist() for k in t.schema.names}
            both = [overlap(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)) for a, b in zip(c["items_x"], c["items_y"], strict=True)]
            good = [i for i, common in enumerate(both) if common >= need(c["n_x"][i], c["n_y"][i], percent)]
            yield as_rows({"x": [c["x"][i] for i in good], "y": [c["y"][i] for i in good], "common": [both[i] for i in good]}, pair_schema)

    sets = stage(rows.mapInArrow(made, "id long, node long, n long, items binary, keys array<long>"), "sets")
    known = stage(sets.groupBy("node").agg(F.min("id").alias("id"), F.count_distinct("id").alias("copies"), F.first("n").alias("n"), F.first("items").alias("items")), "nodes")
    keys = stage(sets.select("node", "n", F.explode("keys").alias("key")).distinct(), "keys")
    x, y = (keys.select("key", F.col("node").alias(c), F.col("n").alias(f"n_{c}")) for c in "xy")
    pairs = x.join(y, "key").filter(f"x < y and 100 * least(n_x, n_y) >= {percent} * greatest(n_x, n_y)").select("x", "y", "n_x", "n_y").distinct()
    for c in "xy":
        pairs = pairs.join(known.select(F.col("node").alias(c), F.col("items").alias(f"items_{c}")), c)
    found = stage(pairs.mapInArrow(compared, "x long, y long, common long"), "links")
    for c in "xy":
        found = found.join(known.select(F.col("node").alias(c), F.struct("id", "n", "copies").alias(f"of_{c}")), c)
    found = found.select(F.least("of_x", "of_y").alias("p"), F.greatest("of_x", "of_y").alias("q"), "common", (F.col("of_x.copies") * F.col("of_y.copies")).alias("links"))
    found = found.select(F.col("p.id").alias("a"), F.col("q.id").alias("b"), F.col("p.n").alias("n_a"), F.col("q.n").alias("n_b"), "common", "links")
    own = known.filter("copies > 1").select(F.col("id").alias("a"), F.col("id").alias("b"), F.col("n").alias("n_a"), F.col("n").alias("n_b"), F.col("n").alias("common"), F.expr("copies * (copies - 1) div 2").alias("links"))
    return found.unionByName(own)
