"""Approximate nearest neighbours by cosine: a navigable small-world graph for each shard, results of all shards merged.

Distinct vectors are dealt into shards by hash. A shard's graph is built in one task, whose memory the bound on a shard's
rows limits, and kept as a table: a row a node, with its neighbours on all levels in one flat array. To search, the shards'
rows and the queries are dealt by shard, the rows of the index before the queries; a task fills its arrays from the former
and answers the latter batch by batch. Candidates of a beam are measured again on the original vectors in double precision.

Every query goes to every shard. Shards grow in rows and in number alike, with the root of the rows, as long as a shard fits
a task; the work of searching then grows with the power 1.5 of the rows (queries being a share of them).

Rows with equal vectors are one node that keeps its k + 1 smallest ids: more can not be among the k nearest of anything.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import hnsw
from .common import as_rows, stage, unstage

#: Rows of a shard: at least, at most, and the factor of the root of all rows.
SHARD_LEAST, SHARD_MOST, SHARD_ROOT = 2_000, 250_000, 36
#: Numbers of all vectors of a shard at most.
SHARD_NUMBERS = 64_000_000
#: Width of a search's beam, and how many of it are measured in double precision.
WIDTH, MEASURED = 128, 48
_NODE = "dim int, shard int, node int, ids array<long>, vec array<double>, links array<int>"
_INDEX = pa.schema([("dim", pa.int32()), ("shard", pa.int32()), ("node", pa.int32()), ("ids", pa.list_(pa.int64())), ("vec", pa.list_(pa.float64())), ("links", pa.list_(pa.int32()))])


def valid_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec, h) of the rows that have an id and a vector of finite numbers that are not all zero; h is the vector's hash."""
    vec = F.col(vec_col).cast("array<double>")
    fit = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("vec", lambda x: x != 0)
    rows = df.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec")).filter("id is not null and vec is not null").filter(fit)
    return rows.withColumn("h", F.xxhash64("vec"))


def _shard_rows(n: int, dim: int) -> int:
    return max(1, min(max(SHARD_LEAST, int(SHARD_ROOT * n**0.5)), SHARD_MOST, SHARD_NUMBERS // dim))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def unit(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """v with a largest component of 1 where its squares could leave the range of doubles, and its lengths."""
    top = np.abs(v).max(axis=1, keepdims=True, initial=0)
    v = np.where((top > 1e100) | (top < 1e-100), v / np.where(top > 0, top, 1), v)
    return v, np.sqrt((v * v).sum(axis=1))


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds one value of the keys; rows come sorted by them."""
    for t in batches:
        if t.num_rows:
            changed = np.zeros(t.num_rows - 1, bool)
            for k in keys:
                x = t.column(k).to_numpy(zero_copy_only=False)
                changed |= x[1:] != x[:-1]
            edge = [0, *(np.flatnonzero(changed) + 1).tolist(), t.num_rows]
            for lo, hi in zip(edge, edge[1:]):
                yield t.slice(lo, hi - lo)


def _built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The index rows of each shard; a shard's rows follow one another in the order of their nodes."""

    def out(dim: int, shard: int, parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(parts).combine_chunks()
        vec, length = unit(np.concatenate([_matrix(p.column("vec"), dim) for p in parts]))
        vec = (vec / length[:, None]).astype(np.float32)
        levels = rows.column("level").to_numpy()
        links = hnsw.build(vec, levels)
        for lo in range(0, len(vec), 10_000):
            hi = min(len(vec), lo + 10_000)
            flat = [np.concatenate([links[k][i] for k in range(levels[i] + 1)]) for i in range(lo, hi)]
            part = rows.slice(lo, hi - lo)
            columns = {"dim": np.full(hi - lo, dim), "shard": np.full(hi - lo, shard), "node": np.arange(lo, hi), "links": flat}
            yield pa.RecordBatch.from_arrays([part.column(f.name).combine_chunks() if f.name not in columns else pa.array(columns[f.name], f.type) for f in _INDEX], schema=_INDEX)

    now, held = None, []
    for t in _grouped(batches, ["dim", "shard"]):
        key = (t.column("dim")[0].as_py(), t.column("shard")[0].as_py())
        if key != now and held:
            yield from out(*now, held)
            held = []
        now = key
        held.append(t)
    if held:
        yield from out(*now, held)


def build_index(df: DataFrame, id_col: str, vec_col: str, k: int = 5) -> DataFrame:
    """The index, written: a row for each distinct vector, (dim, shard, node, ids, vec, links).

    ids are the k + 1 smallest ids of a vector, vec its numbers, links the flat array of neighbours: 2 M nodes of level 0,
    then M for each level above. Vectors of different lengths are in different shards. Null, zero and unfinished vectors
    and rows without an id are left out; empty input gives an empty index.
    """
    rows = valid_vectors(df, id_col, vec_col)
    same = Window.partitionBy("h", "vec").orderBy("id")
    few = rows.withColumn("place", F.dense_rank().over(same)).filter(F.col("place") <= k + 1)  # cut before the shuffle as well
    nodes = few.groupBy("h", "vec").agg(F.array_sort(F.collect_set("id")).alias("ids"))
    nodes = stage(nodes.withColumn("dim", F.size("vec")), "vectors")
    shards = {dim: -(-n // _shard_rows(n, dim)) for dim, n in sorted(nodes.groupBy("dim").count().collect())}  # a row for each length of vectors
    first, total = F.lit(0), 0
    many = F.lit(1)
    for dim, count in shards.items():
        first, many = F.when(F.col("dim") == dim, total).otherwise(first), F.when(F.col("dim") == dim, count).otherwise(many)
        total += count
    spread = F.xxhash64("h", F.lit(1))
    level = F.floor(-F.log((F.pmod(F.xxhash64("h", F.lit(2)), F.lit(1 << 30)) + 1) / float(1 << 30)) / F.lit(float(np.log(hnsw.M)))).cast("int")
    dealt = nodes.select("dim", (first + F.pmod(spread, many)).cast("int").alias("shard"), level.alias("level"), "h", "ids", "vec")
    dealt = dealt.repartitionById(max(total, 1), "shard").sortWithinPartitions("shard", F.desc("level"), "h", "vec")
    out = stage(dealt.mapInArrow(_built, _NODE), "index")
    unstage(nodes)
    return out


class _Shard:
    """A shard's arrays, filled from index rows."""

    def __init__(self, parts: list[pa.RecordBatch], dim: int) -> None:
        self.vec, self.length = unit(np.concatenate([_matrix(p.column("vec"), dim) for p in parts]))
        self.unit = (self.vec / self.length[:, None]).astype(np.float32)
        ids = pa.chunked_array([p.column("ids") for p in parts]).combine_chunks()
        self.n_ids = np.diff(ids.offsets.to_numpy())
        self.id, self.id_begin = ids.flatten().to_numpy(), np.cumsum(self.n_ids) - self.n_ids
        flat = pa.chunked_array([p.column("links") for p in parts]).combine_chunks()
        size, value = np.diff(flat.offsets.to_numpy()), flat.flatten().to_numpy()
        begin = np.cumsum(size) - size
        self.links = [value[begin[:, None] + np.arange(2 * hnsw.M)]]
        for low in range(2 * hnsw.M, int(size.max()), hnsw.M):
            self.links.append(value[begin[size > low][:, None] + low + np.arange(hnsw.M)])

    def nearest(self, query_id: np.ndarray, q: np.ndarray, k: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place of the query, id, score) of the k nearest found of each query, without its own id."""
        q, q_length = unit(q)
        found = []
        step = hnsw.batch_of(len(self.vec))
        for lo in range(0, len(q), step):
            part = (q[lo : lo + step] / q_length[lo : lo + step, None]).astype(np.float32)
            node = hnsw.search(self.unit, self.links, part, width)[0][:, :MEASURED]
            at, slot = np.nonzero(node >= 0)
            node, at = node[at, slot], at + lo
            score = (q[at] * self.vec[node]).sum(axis=1) / (q_length[at] * self.length[node])
            copies = self.n_ids[node]
            place = np.repeat(self.id_begin[node] - (np.cumsum(copies) - copies), copies) + np.arange(copies.sum())
            at, score, ids = np.repeat(at, copies), np.repeat(score, copies), self.id[place]
            other = ids != query_id[at]
            at, score, ids = at[other], score[other], ids[other]
            order = np.lexsort((ids, -score, at))
            at, score, ids = at[order], score[order], ids[order]
            first = np.searchsorted(at, at, "left")
            top = np.arange(len(at)) - first < k
            found.append((at[top], ids[top], score[top]))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def search_index(index: DataFrame, queries: DataFrame, id_col: str, vec_col: str, k: int = 5, width: int = WIDTH) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query among the index's rows of other ids.

    score is the cosine of the original vectors in double precision, rank counts from the highest, ties to the smaller
    vec_id. A query with fewer candidates of its vector's length gets them all that were found. Queries that are null, zero
    or not finite, or have no id, get none; repeated queries are one, queries of one id with other vectors are each ranked
    by themselves.
    """
    shards = index.groupBy("dim").agg(F.min("shard").alias("lo"), F.max("shard").alias("hi")).collect()  # a row for each length of vectors
    total = max((r.hi for r in shards), default=-1) + 1
    every = F.array().cast("array<int>")
    for r in shards:
        every = F.when(F.size("vec") == r.dim, F.sequence(F.lit(r.lo), F.lit(r.hi))).otherwise(every)
    asked = valid_vectors(queries, id_col, vec_col).dropDuplicates(["h", "id", "vec"])
    asked = asked.select(F.size("vec").alias("dim"), F.explode(every).alias("shard"), F.lit(-1).alias("node"), F.array("id").alias("ids"), "vec", F.array().cast("array<int>").alias("links"), "h")
    both = index.select(*_INDEX.names, F.lit(None).cast("long").alias("h")).unionByName(asked.select(*_INDEX.names, "h"))
    dealt = both.withColumn("kind", (F.col("node") < 0).cast("int")).repartitionById(max(total, 1), "shard").sortWithinPartitions("shard", "kind", "node")
    schema = pa.schema([("query_id", pa.int64()), ("query_hash", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, shard = [], None
        for t in _grouped(batches, ["shard", "kind"]):
            dim = t.column("dim")[0].as_py()
            if t.column("kind")[0].as_py() == 0:
                if shard is not None:
                    parts, shard = [], None
                parts.append(t)
                continue
            if shard is None:
                shard, parts = _Shard(parts, dim), []
            mine = t.column("ids").flatten().to_numpy()
            at, ids, score = shard.nearest(mine, _matrix(t.column("vec"), dim), k, width)
            yield as_rows({"query_id": mine[at], "query_hash": t.column("h").to_numpy(zero_copy_only=False)[at], "vec_id": ids, "score": score}, schema)

    found = dealt.mapInArrow(searched, "query_id long, query_hash long, vec_id long, score double")
    order = Window.partitionBy("query_id", "query_hash").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
