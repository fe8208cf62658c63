"""Exact linking of sets whose Jaccard similarity reaches a whole per cent, without comparing all pairs.

A *node* is a distinct set (its 64-bit fingerprint), so copies cost nothing beyond their first. A caller gives

* postings (bucket, kind, data): packed arrays of (key, node), made by `Combiner`. Nodes that share a key are to be
  compared. A key that several nodes of one chunk hold is posted once; its other nodes go along as followers of the first
  and are dealt out by their own hash, so a key that a third of all rows hold reaches its bucket once per chunk;
* bits_of(nodes): (node, n, bits) for a written table of nodes, more nodes do no harm: each one's size and hashed bitmap,
  a few bits for every item; or none, if the postings carry them (`Combiner.describe`);
* fetch(nodes): (node, items) for a table of nodes: their sorted distinct hashes, or what else `kind` compares.

`link` then finds the components of the graph whose edges are all similar pairs that share a key:

1. Every node is compared with the leads of its keys, by bitmaps and then exactly. This is linear in the postings,
   whatever the group sizes.
2. Components of these links. A key of two members needs nothing more.
3. The members beside their lead of all keys that have the same lead are one group, so that a pair that shares hundreds of
   keys is compared once for each such node, not for each key; and a group most of which lies in a larger one has become
   a part of it before 1 (`_absorbed`), so that a pair is not compared again for each lead. A group of at most BLOCK_ITEMS is one tile, unless it has many
   members of unlike sizes. Another is dealt into bands of sizes that grow by the similarity, of which only neighbours can match, a band into blocks of bounded
   size; each pair of blocks is one tile. Inside a tile numpy bounds each pair across components by its bitmaps. The
   members with a pair that passes get their items, and are dealt into tiles again for the exact intersection. So no pair
   that shares a key is lost, and no group is gathered whole. Small tiles go through a task together.
4. The links of 3 are between components of 2, so only these are contracted once more.

What 3 needs of a node, its size and bits, goes along from 1, where both ends' bits meet: joining the table of all nodes
once more would shuffle most of them in vain.

A pair is first bounded from above (`Bitmaps`): a bit that is set for one set only stands for at least one item of it
alone, so overlap <= min(|a| - bits only in a, |b| - bits only in b). Only pairs that pass are intersected exactly. Another
class may take the place of `Bitmaps`, with an exact comparison of its own and a bound that holds with a chance that is
good enough.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from .common import as_rows, in_slices, keys_hint, stage, unstage
from .hashing import mix

ITEMS = pa.schema([("node", pa.int64()), ("items", pa.binary())])
ITEMS_DDL = "node long, items binary"
POSTINGS = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("data", pa.binary())])
POSTINGS_DDL = "bucket int, kind int, data binary"
LED_DDL = "kind int, key long, node long, lead long, n long, bits binary"
#: Postings that one chunk combines at once, and items (8 bytes each) that one block of a tile holds at most.
CHUNK, BLOCK_ITEMS = 400_000, 500_000
#: Postings that a bucket holds on average (12 bytes each), and items of small tiles that a task takes together.
BUCKET, TOGETHER = 500_000, 2_000_000
#: Rows of a tile up to which its pairs are bounded together with those of others, and how many pairs at once.
SMALL, PAIRS_AT_ONCE = 64, 100_000
#: Members of a group from which it is worth asking whether most of it lies in a larger one.
WORTH = 16
#: Pairs of large tiles, found a row at a time, whose sets are made together.
TAKEN = 1_000
#: Bytes of items that are made into sets at once, and items of the sets that a task holds.
AT_ONCE, HELD = 1_000_000, 3_000_000


def bitmap(items: np.ndarray) -> bytes:
    """A bit for each item's hash; twice as many bits as items, in powers of two from 64 to 65,536."""
    size = 1 << min(16, max(6, int(2 * max(1, len(items)) - 1).bit_length()))
    bits = np.zeros(size, bool)
    bits[(items & np.uint64(size - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def folded(bits: np.ndarray, size: int) -> np.ndarray:
    """The same set's bitmap of a smaller size."""
    return np.bitwise_or.reduce(bits.reshape(-1, size), axis=0) if len(bits) > size else bits


def need(n_a, n_b, percent: int):
    """The least overlap at which 100 * intersection >= percent * union."""
    return -((-percent * (n_a + n_b)) // (100 + percent))


def bound(a: np.ndarray, n_a: int, b: np.ndarray, n_b: int) -> int:
    """An upper bound of the overlap, from bit counts."""
    size = min(len(a), len(b))
    a, b = folded(a, size), folded(b, size)
    both = int(np.bitwise_count(a & b).sum())
    return min(n_a - int(np.bitwise_count(a).sum()) + both, n_b - int(np.bitwise_count(b).sum()) + both)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays of distinct items."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    return bool(overlap(a, b) >= need(len(a), len(b), percent))


def item_rows(nodes: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
    return as_rows({"node": nodes, "items": [x.tobytes() for x in sets]}, ITEMS)


def buckets_for(postings: int) -> int:
    return max(8, -(-postings // BUCKET))


class Combiner:
    """Collects postings of a task and gives them out in chunks, packed by bucket.

    Kind 0 holds the last 32 bits of keys and their nodes; the bucket stands for the first bits, and keys that differ in
    the others are compared in vain at worst. Kind 3 holds the same of keys with followers. Kind 1 holds followers: whole
    keys, nodes, and their leads. Kind 2 holds nodes, their sizes and bits, dealt out by the nodes' hash.
    """

    def __init__(self, buckets: int) -> None:
        self.buckets, self.keys, self.nodes, self.held, self.described = buckets, [], [], 0, []

    def add(self, nodes: np.ndarray, keys: np.ndarray) -> None:
        """Keys and the node of each."""
        self.keys.append(keys)
        self.nodes.append(nodes)
        self.held += len(keys)

    def describe(self, nodes: np.ndarray, n: np.ndarray, bits: np.ndarray) -> None:
        """Sizes and bits (a row of equal length for each) of nodes, which go along with the postings as kind 2."""
        self.described.append((nodes, n, bits))

    def _bucket(self, hashed: np.ndarray) -> np.ndarray:
        return ((hashed >> np.uint64(32)) * np.uint64(self.buckets)) >> np.uint64(32)

    def batches(self, last: bool = False) -> Iterator[pa.RecordBatch]:
        if not self.held or not last and self.held < CHUNK:
            return
        keys, nodes = np.concatenate(self.keys), np.concatenate(self.nodes)
        self.keys, self.nodes, self.held = [], [], 0
        bucket = self._bucket(keys)
        keys = (bucket << np.uint64(32)) | (keys & np.uint64(0xFFFFFFFF))
        order = np.argsort(keys)  # by bucket as well
        keys, nodes, bucket = keys[order], nodes[order], bucket[order]
        first = np.r_[True, keys[1:] != keys[:-1]]
        lead = nodes[np.flatnonzero(first)[np.cumsum(first) - 1]]
        follow = ~first & (nodes != lead)  # a node may have a key twice
        rows: list[tuple[int, int, bytes]] = []
        led = np.logical_or.reduceat(follow, np.flatnonzero(first))
        for kind, those in ((0, ~led), (3, led)):
            k, v, b = (x[first][those] for x in (keys.astype(np.uint32), nodes, bucket))
            for lo, hi in self._runs(b):
                rows.append((int(b[lo]), kind, k[lo:hi].tobytes() + v[lo:hi].tobytes()))
        if follow.any():
            own = self._bucket(mix(nodes[follow].view(np.uint64)))
            order = np.argsort(own, kind="stable")
            own, parts = own[order], [x[follow][order] for x in (keys.view(np.int64), nodes, lead)]
            for lo, hi in self._runs(own):
                rows.append((int(own[lo]), 1, b"".join(x[lo:hi].tobytes() for x in parts)))
        if self.described:
            nodes, n, bits = (np.concatenate(x) for x in zip(*self.described, strict=True))
            self.described = []
            own = self._bucket(mix(nodes.view(np.uint64)))
            order = np.argsort(own, kind="stable")
            for lo, hi in self._runs(own[order]):
                at = order[lo:hi]
                rows.append((int(own[at[0]]), 2, nodes[at].tobytes() + n[at].astype(np.int64).tobytes() + bits[at].tobytes()))
        yield as_rows(dict(zip(POSTINGS.names, zip(*rows, strict=True), strict=True)), POSTINGS)

    @staticmethod
    def _runs(of: np.ndarray) -> Iterator[tuple[int, int]]:
        edge = np.flatnonzero(np.r_[True, of[1:] != of[:-1], True]) if len(of) else np.empty(0, int)
        return zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)


LED = pa.schema([("kind", pa.int32()), ("key", pa.int64()), ("node", pa.int64()), ("lead", pa.int64()), ("n", pa.int64()), ("bits", pa.binary())])
#: Kinds of rows: a node and its lead, the only members of a key that is known to have no more; a node and its lead; a
#: follower and its chunk's lead; a described node.
PAIR, MEMBER, FOLLOWER, TOLD = range(4)


def _led(rows: pa.Table, width: int) -> pa.Table:
    """One bucket: every node of a shared key with the key's least node as lead (the key beside it if the node has
    followers), the followers as they are, and each described node once (bits of `width` bytes)."""
    keys, nodes, many, done, told = [], [], [], [], []
    for bucket, kind, data in zip(*(rows.column(c).to_pylist() for c in POSTINGS.names), strict=True):
        if kind == 2:
            n = len(data) // (16 + width)
            told.append((np.frombuffer(data, np.int64, 2 * n).reshape(2, -1), np.frombuffer(data, np.uint8, offset=16 * n).reshape(n, width)))
        elif kind == 1:
            done.append(np.frombuffer(data, np.int64).reshape(3, -1))
        else:
            n = len(data) // 12
            keys.append(np.frombuffer(data, np.uint32, n).astype(np.int64) | (int(bucket) << 32))
            nodes.append(np.frombuffer(data, np.int64, n, 4 * n))
            many.append(np.full(n, kind == 3))
    none = lambda n, c: pa.nulls(n, LED.field(c).type)
    out = [LED.empty_table()]
    if keys:
        k, v, m = np.concatenate(keys), np.concatenate(nodes), np.concatenate(many)
        order = np.argsort(k)
        twice = np.flatnonzero(np.diff(k[order]) == 0)
        order = order[np.union1d(twice, twice + 1)]  # most keys are held once
        k, v, m = k[order], v[order], m[order]
    if keys and len(k):
        order = np.lexsort((v, k))
        k, v, m = k[order], v[order], m[order]
        new = np.r_[True, (k[1:] != k[:-1]) | (v[1:] != v[:-1])]  # a node may have been given out by several chunks
        m = np.logical_or.reduceat(m, np.flatnonzero(new))
        k, v = k[new], v[new]
        start = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
        size = np.diff(np.r_[start, len(k)])
        lead, more = np.repeat(v[start], size), np.repeat((size > 2) | np.logical_or.reduceat(m, start), size)
        use = np.ones(len(k), bool)
        use[start] = False
        kind = pa.array(np.where(more[use], MEMBER, PAIR).astype(np.int32))
        out.append(pa.Table.from_arrays([kind, pa.array(k[use], mask=~m[use]), pa.array(v[use]), pa.array(lead[use]), none(use.sum(), "n"), none(use.sum(), "bits")], schema=LED))
    if done:
        led = np.concatenate(done, axis=1)
        n = led.shape[1]
        out.append(pa.Table.from_arrays([pa.array(np.full(n, FOLLOWER, np.int32)), *map(pa.array, led), none(n, "n"), none(n, "bits")], schema=LED))
    if told:
        (node, n), bits = np.concatenate([x for x, _ in told], axis=1), np.concatenate([x for _, x in told])
        node, at = np.unique(node, return_index=True)
        ends = pa.py_buffer(np.arange(len(at) + 1, dtype=np.int32) * width)
        packed = pa.Array.from_buffers(pa.binary(), len(at), [None, ends, pa.py_buffer(np.ascontiguousarray(bits[at]))])
        out.append(pa.Table.from_arrays([pa.array(np.full(len(at), TOLD, np.int32)), none(len(at), "key"), pa.array(node), none(len(at), "lead"), pa.array(n[at]), packed], schema=LED))
    return pa.concat_tables(out)


class Bitmaps:
    """Upper bounds of overlaps, from bitmaps of sets and their sizes n."""

    def __init__(self, bits: list[bytes], n: np.ndarray, percent: int) -> None:
        self.bits, self.n = bits, n

    @staticmethod
    def sets(items: list[bytes]) -> list[np.ndarray]:
        """The sorted distinct items of each set."""
        return [np.frombuffer(x, np.uint64) for x in items]

    def upper(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """`bound` of the pairs i, j; those of equal bitmap sizes together."""
        out = np.empty(len(i), np.int64)
        length = np.array([len(x) for x in self.bits])
        size = np.stack([length[i], length[j]], axis=1)
        for sa, sb in np.unique(size, axis=0):
            at = np.flatnonzero((size[:, 0] == sa) & (size[:, 1] == sb))
            least = min(sa, sb)
            a, b = (np.bitwise_or.reduce(np.frombuffer(b"".join([self.bits[k] for k in x[at]]), np.uint64).reshape(len(at), -1, least // 8), axis=1) for x in (i, j))
            both = np.bitwise_count(a & b).sum(axis=1, dtype=np.int64)
            alone = [self.n[x[at]] - np.bitwise_count(y).sum(axis=1, dtype=np.int64) for x, y in ((i, a), (j, b))]
            out[at] = np.minimum(*alone) + both
        return out

    def among(self, at: np.ndarray) -> Callable[[int, np.ndarray], np.ndarray]:
        """The same for a place of `at` and many others, all folded to one size."""
        raw = [np.frombuffer(self.bits[x], np.uint8) for x in at]
        bits = np.stack([folded(x, min(map(len, raw))) for x in raw]).view(np.uint64)
        alone = self.n[at] - np.bitwise_count(bits).sum(axis=1).astype(np.int64)
        return lambda i, j: np.minimum(alone[i], alone[j]) + np.bitwise_count(bits[j] & bits[i]).sum(axis=1).astype(np.int64)


PAIRS = pa.schema([(k, pa.int64()) for k in ("a", "b", "n_a", "n_b")])
PAIRS_DDL = "a long, b long, n_a long, n_b long"
NEAR_DDL = f"{PAIRS_DDL}, bits_b binary, more boolean, may boolean"


def by_bits(percent: int, kind: type) -> Callable:
    """A function of Arrow batches that tells of the pairs (a, b, n_a, n_b, bits_a, bits_b, more) whether they may be
    similar, and keeps those that may and those with more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in in_slices(in_slices(batches, "bits_a"), "bits_b"):
            n_a, n_b = (t.column(c).to_numpy(zero_copy_only=False) for c in ("n_a", "n_b"))
            both = kind(t.column("bits_a").to_pylist() + t.column("bits_b").to_pylist(), np.r_[n_a, n_b], percent)
            at = np.arange(t.num_rows)
            may = (need(n_a, n_b, percent) <= np.minimum(n_a, n_b)) & (both.upper(at, at + t.num_rows) >= need(n_a, n_b, percent))
            use = pa.array(may | t.column("more").to_numpy(zero_copy_only=False))
            names = [*PAIRS.names, "bits_b", "more"]
            yield pa.RecordBatch.from_arrays([*(t.column(c).filter(use) for c in names), pa.array(may).filter(use)], names=[*names, "may"])

    return run


def by_items(percent: int, kind: type) -> Callable:
    """A function of Arrow batches that keeps the pairs (a, b, n_a, n_b, items_a, items_b) that are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in in_slices(in_slices(batches, "items_a", AT_ONCE), "items_b", AT_ONCE):
            x, y = t.column("items_a").to_pylist(), t.column("items_b").to_pylist()
            every = list({*x, *y})
            sets = dict(zip(every, kind.sets(every), strict=True))
            good = pa.array([similar(sets[a], sets[b], percent) for a, b in zip(x, y, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([t.column(c).filter(good) for c in PAIRS.names], schema=PAIRS)

    return run


def _large(t: dict, maps, percent: int, lo: int, hi: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """`passing` for the rows lo to hi, one tile: a whole row of pairs is bounded at a time. Rows of the tile's largest
    component come last within their side and are not compared with each other."""
    side, root = t["side"][lo:hi], t["root"][lo:hi]
    of, times = np.unique(root, return_counts=True)
    largest = root == of[times.argmax()]
    at = np.lexsort((t["n"][lo:hi], largest, side)) + lo
    largest, side, n, root = largest[at - lo], t["side"][at], t["n"][at], t["root"][at]
    upper, one_block, other = maps.among(at), side[0] == side[-1], int((side == 0).sum())
    stop = int(np.flatnonzero(~largest)[-1]) + 1  # after it, all are of the largest
    for i in range(stop if one_block else other):
        first, last = (i + 1 if one_block else other), (stop if largest[i] else len(at))
        least = need(n[i], n[first:last], percent)
        j = np.flatnonzero((least <= np.minimum(n[i], n[first:last])) & (root[first:last] != root[i])) + first
        j = j[upper(i, j) >= least[j - first]]
        if len(j):
            yield np.full(len(j), at[i]), at[j]


def passing(t: dict, percent: int, kind: type) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The places of pairs in different components that the bitmaps let pass, within each tile of a task.

    t: arrays of the task's rows, sorted by tile and side. A tile's rows are of two blocks (side 0 and 1), which are
    compared with each other; a diagonal tile has one side alone, which is compared with itself. The pairs of many small
    tiles are bounded together.
    """
    maps = kind(t["bits"].tolist(), t["n"], percent)
    start = np.flatnonzero(np.r_[True, t["tile"][1:] != t["tile"][:-1]])
    size = np.diff(np.r_[start, len(t["tile"])])
    mixed = np.minimum.reduceat(t["root"], start) < np.maximum.reduceat(t["root"], start)
    two = np.minimum.reduceat(t["side"], start) < np.maximum.reduceat(t["side"], start)
    for k in np.flatnonzero(mixed & (size > SMALL)):
        yield from _large(t, maps, percent, start[k], start[k] + size[k])
    for s in np.unique(size[mixed & (size <= SMALL)]):
        x, y = np.triu_indices(s, 1)
        those = np.flatnonzero(mixed & (size == s))
        for some in np.array_split(those, -(-len(those) * len(x) // PAIRS_AT_ONCE)):
            i, j = (start[some][:, None] + x).ravel(), (start[some][:, None] + y).ravel()
            n_i, n_j = t["n"][i], t["n"][j]
            use = (t["root"][i] != t["root"][j]) & ((t["side"][i] != t["side"][j]) | ~np.repeat(two[some], len(x))) & (100 * np.minimum(n_i, n_j) >= percent * np.maximum(n_i, n_j))
            i, j, n_i, n_j = i[use], j[use], n_i[use], n_j[use]
            if len(i):
                good = maps.upper(i, j) >= need(n_i, n_j, percent)
                yield i[good], j[good]


def gathered(pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same pairs, some TAKEN at once."""
    some, held = [], 0
    for ij in pairs:
        some.append(ij)
        held += len(ij[0])
        if held >= TAKEN:
            yield tuple(map(np.concatenate, zip(*some, strict=True)))
            some, held = [], 0
    if some:
        yield tuple(map(np.concatenate, zip(*some, strict=True)))


def task_rows(rows: pd.DataFrame) -> dict:
    """The columns of a task's rows as arrays, sorted by tile, side and size, and the number of each row's tile."""
    tile = rows.groupby(["lead", "band", "p", "q", "next"], sort=False).ngroup().to_numpy()
    order = np.lexsort((rows["n"], rows["side"], tile))
    return {c: rows[c].to_numpy()[order] for c in rows.columns} | {"tile": tile[order]}


MEMBERS_DDL = "lead long, node long, root long, n long, bits binary"


def near_nodes(rows: pd.DataFrame, percent: int, kind: type) -> pd.DataFrame:
    """The members of a task with a passing pair in their tile."""
    t = task_rows(rows)
    hit = np.zeros(len(rows), bool)
    for i, j in passing(t, percent, kind):
        hit[i] = hit[j] = True
    return pd.DataFrame({c: t[c][hit] for c in ("lead", "node", "root", "n", "bits")})


def new_links(rows: pd.DataFrame, percent: int, kind: type) -> pd.DataFrame:
    """Links (of roots a, b) between the components of a task's tiles, whose rows have items. A link joins components at
    once, so that a pair that is connected already is not intersected again."""
    t = task_rows(rows)
    root = t["root"].tolist()
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    links = []
    sets: dict[int, np.ndarray] = {}  # of the rows by place, and their bitmaps, up to HELD items
    bits: dict[int, bytes] = {}
    held = 0
    for i, j in gathered(passing(t, percent, kind)):
        if held > HELD:
            sets, bits, held = {}, {}, 0
        at, back = np.unique(np.r_[i, j], return_inverse=True)
        new = [k for k in at.tolist() if k not in sets]
        for some in np.array_split(np.array(new, int), sum(len(t["items"][k]) for k in new) // AT_ONCE + 1):
            for k, x in zip(some.tolist(), kind.sets([t["items"][k] for k in some]), strict=True):
                sets[k] = x
                held += len(x)
                if kind is not Bitmaps:  # they bound more sharply than what let the pair pass
                    bits[k] = bitmap(x)
        good = np.ones(len(i), bool)
        if bits:
            x, y, n = back[: len(i)], back[len(i) :], np.array([len(sets[k]) for k in at])
            good = Bitmaps([bits[k] for k in at], n, percent).upper(x, y) >= need(n[x], n[y], percent)
        for x, y in zip(i[good].tolist(), j[good].tolist(), strict=True):
            a, b = find(root[x]), find(root[y])
            if a != b and similar(sets[x], sets[y], percent):
                parent[max(a, b)] = min(a, b)
                links.append((root[x], root[y]))
    return pd.DataFrame(links, columns=["a", "b"]).astype("int64")


def _absorbed(members: DataFrame) -> DataFrame:
    """members (lead, node) with a group most of which lies in a larger one as part of that one, and its lead as a member. A
    node may then be there several times under one lead. All pairs of the old groups, with their leads, are within the new
    ones, and these have no more pairs, but for the leads that come along.

    The sets of a large family of near copies share many keys of different leads, whose groups are much the same nodes: each
    node would be there once for each lead, and each pair be compared as often. Every node names its largest group, and a
    group goes to the one that most of its members name, if at least half do and that one stays itself. Where a group would
    have more pairs with all that come than they and it had before, only those come that bring no new nodes.
    """
    sizes = stage(members.groupBy("lead").agg(F.count(F.lit(1)).alias("c")).filter(f"c >= {WORTH}"), "sizes")
    of = members.select("lead", "node").join(keys_hint(sizes), "lead").groupBy("node").agg(F.collect_list(F.struct("c", "lead")).alias("of"))
    of = stage(of.select("node", F.array_max("of").alias("hub"), "of"), "of")
    each = of.select("node", "hub", F.explode("of").alias("own"))
    named = each.groupBy("own", "hub").agg(F.count(F.lit(1)).alias("times")).groupBy("own").agg(F.max(F.struct("times", "hub")).alias("most"))
    may = named.select("own.lead", "own.c", F.col("most.hub.lead").alias("to"), F.col("most.hub.c").alias("s"), (F.col("own.c") - F.col("most.times")).alias("new"))
    may = stage(may.filter("to <> lead and 2 * new <= c"), "may")
    go = may.join(may.select(F.col("lead").alias("to")), "to", "left_anti")
    new = each.join(go, (F.col("own.lead") == F.col("lead")) & (F.col("hub.lead") != F.col("to"))).select("to", "node").distinct().groupBy("to").agg(F.count(F.lit(1)).alias("more"))
    full = go.groupBy("to").agg(F.sum(F.expr("double(c) * c")).alias("pairs"), F.first("s").alias("s")).join(new, "to").filter("double(s + more) * (s + more) > pairs + double(s) * s")
    go = go.join(full.select("to", F.lit(True).alias("full")), "to", "left").filter("full is null or new = 0")
    go = stage(go.select("lead", "to"), "absorbed")
    unstage(sizes, of, may)
    return members.join(keys_hint(go), "lead", "left").withColumn("lead", F.coalesce("to", "lead")).drop("to").unionByName(go.select(F.col("to").alias("lead"), F.col("lead").alias("node")))


def _tiled(members: DataFrame, percent: int) -> DataFrame:
    """members (lead, node, root, n, ..) of groups by lead, dealt into tiles: columns tile and side.

    A group of at most BLOCK_ITEMS is one tile, if its sizes are within one band or its pairs are bounded one by one (a
    larger tile's bitmaps are folded to the least size). Only the others are dealt into bands of sizes and blocks."""
    of = members.groupBy("lead").agg(F.sum("n").alias("items"), F.count(F.lit(1)).alias("c"), F.min("n").alias("least"), F.max("n").alias("most"))
    large = stage(of.filter(f"items > {BLOCK_ITEMS} or c > {SMALL} and 100 * least < {percent} * most").select("lead"), "large")
    one_tile = F.struct(*[F.lit(0).alias(c) for c in ("band", "p", "q", "next")])
    whole = lambda df: df.withColumn("tile", one_tile).withColumn("side", F.lit(0))
    if large.isEmpty():
        return whole(members)
    large = keys_hint(large)
    return whole(members.join(large, "lead", "left_anti")).unionByName(_banded(members.join(large, "lead", "left_semi"), percent))


def _banded(members: DataFrame, percent: int) -> DataFrame:
    """members dealt into bands of sizes and these into blocks, each with every block of its own band and of the next. The
    sizes of two similar sets differ at most by a factor of 100 / percent, which is a band's width, so they lie in the same
    band or in neighbouring ones."""
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(float(np.log(100 / percent)) * (1 + 1e-9))).cast("int")  # a bit wider
    members = members.withColumn("band", band)
    blocks = members.groupBy("lead", "band").agg(F.ceil(F.sum("n") / BLOCK_ITEMS).cast("int").alias("blocks"))
    after = blocks.select("lead", (F.col("band") - 1).alias("band"), F.col("blocks").alias("above"))
    before = blocks.select("lead", (F.col("band") + 1).alias("band"), F.col("blocks").alias("below"))
    counts = blocks.join(after, ["lead", "band"], "left").join(before, ["lead", "band"], "left").na.fill(0)
    dealt = members.join(counts, ["lead", "band"]).withColumn("block", F.expr("pmod(xxhash64(node, 7), blocks)").cast("int"))
    own = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda q: F.struct(F.col("band").alias("band"), F.least("block", q).alias("p"), F.greatest("block", q).alias("q"), F.lit(0).alias("next"), F.when(F.col("block") > q, 1).otherwise(0).alias("side")))
    up = F.transform(F.sequence(F.lit(1), F.col("above")), lambda q: F.struct(F.col("band").alias("band"), F.col("block").alias("p"), (q - 1).alias("q"), F.lit(1).alias("next"), F.lit(0).alias("side")))
    down = F.transform(F.sequence(F.lit(1), F.col("below")), lambda p: F.struct((F.col("band") - 1).alias("band"), (p - 1).alias("p"), F.col("block").alias("q"), F.lit(1).alias("next"), F.lit(1).alias("side")))
    none = F.array().cast("array<struct<band:int,p:int,q:int,next:int,side:int>>")
    tiles = F.concat(own, F.when(F.col("above") > 0, up).otherwise(none), F.when(F.col("below") > 0, down).otherwise(none))
    out = dealt.withColumn("t", F.explode(tiles)).withColumn("tile", F.struct("t.band", "t.p", "t.q", "t.next")).withColumn("side", F.col("t.side"))
    return out.drop("band", "blocks", "above", "below", "block", "t")


def _by_task(tiled: DataFrame, items: int) -> DataFrame:
    """Tiles grouped into tasks, by hash, so that one holds TOGETHER of all items on average."""
    task = F.pmod(F.xxhash64("lead", "tile"), F.lit(max(64, items // TOGETHER)))
    return tiled.select("*", "tile.*").withColumn("task", task).drop("tile").groupBy("task")


def _items_of(members: DataFrame) -> int:
    return members.agg(F.sum("n").alias("n")).first().n or 0


def _across(sized: DataFrame, items: int, fetch: Callable[[DataFrame], DataFrame], percent: int, kind: type) -> DataFrame:
    """Links (roots a, b) between members (lead, node, root, n, bits), of so many items in all, of the same group and
    different components."""

    near = _by_task(_tiled(sized, percent), items // 16).applyInPandas(lambda rows: near_nodes(rows, percent, kind), MEMBERS_DDL)
    rest = stage(near.dropDuplicates(["lead", "node"]), "near")  # a member may lie in several tiles
    fetched = stage(fetch(rest.select("node").distinct()), "items")
    found = _by_task(_tiled(rest, percent).join(fetched, "node"), _items_of(rest)).applyInPandas(lambda rows: new_links(rows, percent, kind), "a long, b long")
    out = stage(found, "links")
    unstage(rest, fetched)
    return out


def _stars(every: DataFrame) -> DataFrame:
    """(a, b, more): every node b with the leads a of its keys, once; more: the keys may have other members."""
    heads = every.filter(f"kind <= {MEMBER} and key is not null").select("key", F.col("node").alias("first"), F.col("lead").alias("least"))
    followers = every.filter(f"kind = {FOLLOWER}").select("key", "node", F.col("lead").alias("first"))
    led = followers.join(heads, ["key", "first"], "left").select(F.coalesce("least", "first").alias("a"), F.col("node").alias("b"), F.lit(1).alias("more"))
    own = every.filter(f"kind <= {MEMBER}").select(F.col("lead").alias("a"), F.col("node").alias("b"), F.col("kind").alias("more"))
    stars = own.unionByName(led).filter("a <> b").groupBy("a", "b").agg(F.max("more").alias("more"))
    return stars.select("a", "b", (F.col("more") == MEMBER).alias("more"))


def link(postings: DataFrame, bits_of: Callable[[DataFrame], DataFrame] | None, fetch: Callable[[DataFrame], DataFrame], percent: int, kind: type = Bitmaps, width: int = 0) -> DataFrame:
    """(node, root) for every node that is similar to another, as the module's head tells. Empty postings: no rows.

    kind: what bounds overlaps from bits; width: bytes of each described node's bits, where postings carry these."""
    every = stage(postings.groupBy("bucket").applyInArrow(lambda rows: _led(rows, width), LED_DDL), "led")
    told = stage(_stars(every), "told")
    groups = _absorbed(told.filter("more").select(F.col("a").alias("lead"), F.col("b").alias("node"))).filter("lead <> node")
    stars = told.filter("not more").unionByName(groups.select(F.col("lead").alias("a"), F.col("node").alias("b"), F.lit(True).alias("more")))
    stars = stage(stars.groupBy("a", "b").agg(F.max("more").alias("more")), "stars")
    unstage(told)
    bits = bits_of(stage(stars.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "nodes")) if bits_of else every.filter(f"kind = {TOLD}").select("node", "n", "bits")

    def with_both(df: DataFrame, table: DataFrame, columns: list[str]) -> DataFrame:
        for side in "ab":
            df = df.join(table.select(F.col("node").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns]), side)
        return df

    near = with_both(stars, bits, ["n", "bits"]).filter(f"more or 100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
    near = stage(near.select(*PAIRS.names, "bits_a", "bits_b", "more").mapInArrow(by_bits(percent, kind), NEAR_DDL), "near")
    passed = near.filter("may").select(*PAIRS.names)
    items = stage(fetch(passed.select(F.explode(F.array("a", "b")).alias("node")).distinct()), "items")
    edges = with_both(passed, items, ["items"]).mapInArrow(by_items(percent, kind), PAIRS_DDL)
    found = connected_components(edges)
    unstage(every, stars, items)

    # each pair with the lead has been compared: the other members of a group are left, unless they are of one component
    members = near.filter("more").select(F.col("a").alias("lead"), F.col("b").alias("node"), F.col("n_b").alias("n"), F.col("bits_b").alias("bits"))
    members = members.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    sized = stage(members.select("lead", "node", "root", "n", "bits"), "members")
    n_items = _items_of(sized)
    unstage(near)
    if not n_items:
        unstage(sized)
        return found
    more = connected_components(_across(sized, n_items, fetch, percent, kind))
    unstage(sized)
    joined = found.join(more.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    alone = more.join(found.select(F.col("root").alias("node")).distinct(), "node", "left_anti")  # nodes that had no link before
    out = stage(joined.unionByName(alone.select("node", "root")), "components")
    unstage(found, more)
    return out
