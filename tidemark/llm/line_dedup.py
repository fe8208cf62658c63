"""Operator 4, line dedup: fuzzy lines by MinHash over character shingles; one line of each component stays.

Lines are compared twice: those of at most SHORT characters by shingles of 3 characters, and all by shingles of 8. One
replaced letter changes as many shingles as they are wide, so at width 8 it leaves a similarity of 0.8 only to lines of 79
characters or more, at width 3 to those of 29 or more; but long unlike lines share too many shingles of 3. The links of
both are joined into components.

Equal lines (lower-cased, blanks folded) are one node by their hash. Each node's signature is a one-permutation MinHash:
its shingles are dealt into ROWS * BANDS bins by hash, the least value of a bin is its entry, and an empty bin borrows
from a bin chosen by hash. Bands of ROWS entries are the keys; 12 bands of 5 miss a pair of similarity 0.8 with a chance
of 0.8 per cent, of 0.85 with 0.1, of 0.9 with 0.002. Four bits of each entry make a sketch, by which candidates that are far from similar
are told (`Sketches`); `setjoin` verifies exact Jaccard similarity of the others and finds components.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from .common import in_slices, keys_hint, stage
from .hashing import STEP, mix
from .setjoin import POSTINGS_DDL, Combiner, buckets_for, link

WIDTH, BANDS, ROWS = 8, 12, 5
#: Characters of a line up to which shingles of SHORT_WIDTH characters are compared as well.
SHORT, SHORT_WIDTH = 110, 3
BINS = BANDS * ROWS
NONE, SCRAMBLE, FOURTH = np.uint32(0xFFFFFFFF), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x1111111111111111)
#: For an empty bin, the bins to borrow from, one try after the other.
BORROW = np.stack([np.random.default_rng(t).integers(0, BINS, BINS) for t in range(400)])
#: Bytes of a sketch (half a byte for each bin, up to a multiple of eight, and a number), deviations that a similar pair may be off, and the size that
#: stands for that of any line: a tile's blocks hold 1 / SIZE of BLOCK_ITEMS lines.
SKETCH, SIGMAS, SIZE = -(-BINS // 16) * 8 + 1, 4.0, 200
#: Lines that a task remembers, so as not to give them out again; characters that are hashed at once.
SEEN, AT_ONCE = 300_000, 60_000
#: A line is hot with more than one in so many of all lines: there are fewer than this of them.
HOT = 2_000
#: What ASCII texts may have between words other than one space.
ODD_BLANKS = ["  ", *"\t\v\f\r\x1c\x1d\x1e\x1f"]


def fold(line: str) -> str:
    return " ".join(line.lower().split())


def folded_lines(text: str) -> list[str]:
    """`fold` of each line. Lower case never depends on what stands beyond a line's end, so the text is lowered at once; in
    ASCII texts whose only blanks are single spaces, the ends of lines are all there is to fold."""
    lines = text.lower().split("\n")
    if text.isascii() and not any(x in text for x in ODD_BLANKS):
        return [x.strip(" ") for x in lines]
    return [" ".join(x.split()) for x in lines]


def node_of(folded: str) -> int:
    """A line's node, which is even; the next odd number is that of its shingles of SHORT_WIDTH."""
    return (xxhash.xxh3_64_intdigest(folded.encode("utf-8", "surrogatepass")) - (1 << 63)) & ~1


def char_shingles(lines: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the character shingles of all lines, and where each line's begin. A shorter line is one shingle."""
    full = [x.ljust(width, "\0") for x in lines]
    raw = np.frombuffer("".join(full).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    rows, span, h, done = len(raw) - width + 1, 1, np.zeros(len(raw), np.uint64), 0
    with np.errstate(over="ignore"):
        while True:  # raw: hashes of `span` characters, a power of two; h: of the first `done` ones of a shingle
            if width & span:
                h = h[: len(raw) - done] * STEP + raw[done : done + len(h)] if done else raw
                done += span
            if done == width:
                break
            before, raw = raw, raw[:-span] * (STEP + np.uint64(2 * span))
            raw += before[span:]
            span *= 2
        h = h[:rows]
        h ^= h >> np.uint64(29)
        h *= SCRAMBLE
        h ^= h >> np.uint64(32)
    size = np.array([len(x) for x in full])
    last = np.zeros(rows + width, bool)
    for back in range(1, width):  # these would run into the next line
        last[np.cumsum(size) - back] = True
    return h[~last[:rows]], np.r_[0, np.cumsum(size - width + 1)[:-1]]


def signatures(lines: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """A row of BINS entries for each line, and how many of these are its own, not borrowed."""
    h, begin = char_shingles(lines, width)
    count = np.diff(np.r_[begin, len(h)])
    value = h.astype(np.uint32)  # the last 32 bits
    h >>= np.uint64(32)
    h *= np.uint64(BINS)
    h >>= np.uint64(32)
    at = h.view(np.int64)
    at += np.repeat(np.arange(len(lines), dtype=np.int64) * BINS, count)
    sig = np.full(len(lines) * BINS, NONE, np.uint32)
    np.minimum.at(sig, at, value)
    sig = sig.reshape(-1, BINS)
    full, out = sig != NONE, sig.copy()
    row, col = np.nonzero(~full)
    for tries in BORROW:
        if not len(row):
            break
        source = tries[col]
        ok = full[row, source]
        out[row[ok], col[ok]] = sig[row[ok], source[ok]]
        row, col = row[~ok], col[~ok]
    if len(row):  # one shingle in all, and no luck: the line's first full bin
        out[row, col] = sig[row, full[row].argmax(axis=1)]
    return out, full.sum(axis=1)


def band_keys(signature: np.ndarray, width: int) -> np.ndarray:
    """The keys of each line, a row of BANDS; those of different widths differ."""
    bands = signature.reshape(-1, BANDS, ROWS).astype(np.uint64)
    with np.errstate(over="ignore"):
        acc = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * STEP + np.uint64(width), bands.shape[:2])
        for r in range(ROWS):
            acc = mix(acc + bands[:, :, r] * STEP)
    return acc


def sketches(signature: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The last four bits of each entry, and at the end the number of own entries: SKETCH bytes for each line."""
    low = (signature & np.uint32(15)).astype(np.uint8)
    out = np.zeros((len(signature), SKETCH), np.uint8)
    out[:, : BINS // 2] = low[:, ::2] << np.uint8(4) | low[:, 1::2]
    out[:, -1] = own
    return out


class Sketches:
    """Overlaps that two lines have at most, by the entries that their sketches share: the share of equal entries, and
    SIGMAS times its deviation at the similarity that is asked for. A similar pair is beyond it with a chance of 3e-5.
    Sizes play no part: all lines count as of one size, so that of two lines with the same shingles, however often each
    has them, none is parted by its length."""

    def __init__(self, bits: list[bytes], n: np.ndarray, percent: int) -> None:
        x = np.frombuffer(b"".join(bits), np.uint8).reshape(len(bits), SKETCH)
        self.x, self.n = np.ascontiguousarray(np.ascontiguousarray(x[:, :-1]).view(np.uint64).T), n
        self.deviation = SIGMAS * np.sqrt(percent * (100 - percent)) / 100 / np.sqrt(x[:, -1])

    @staticmethod
    def sets(items: list[bytes]) -> list[np.ndarray]:
        """The sorted distinct shingles of lines, each of which has their width before it."""
        out: list[np.ndarray] = [None] * len(items)
        for width in {x[0] for x in items}:
            at = [i for i, x in enumerate(items) if x[0] == width]
            for some, lines in parts(at, [items[i][1:].decode("utf-8", "surrogatepass") for i in at]):
                h, begin = char_shingles(lines, width)
                edge = np.r_[begin, len(h)].tolist()
                for lo, hi in itertools.pairwise(edge):
                    h[lo:hi].sort()
                new = np.r_[True, h[1:] != h[:-1]]
                new[begin] = True
                for i, x in zip(some, np.split(h[new], np.add.reduceat(new, begin).cumsum()[:-1]), strict=True):
                    out[i] = x
        return out

    def upper(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        apart = np.zeros(len(j), np.uint8)
        for at in range(0, len(self.x), 4):  # a bit for each of 16 entries, of four words side by side
            unlike = np.zeros(len(j), np.uint64)
            for k, word in enumerate(self.x[at : at + 4]):
                d = word[i] ^ word[j]
                d |= d >> np.uint64(1)
                d |= d >> np.uint64(2)
                d &= FOURTH
                d <<= np.uint64(k)
                unlike |= d
            apart += np.bitwise_count(unlike)
        like = np.minimum(1 - apart / BINS + np.maximum(self.deviation[i], self.deviation[j]), 1)
        return np.ceil(like / (1 + like) * (self.n[i] + self.n[j])).astype(np.int64)

    def among(self, at: np.ndarray):
        return lambda i, j: self.upper(at[i], at[j])


def parts(nodes: list[int], lines: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """Nodes and their lines, about AT_ONCE characters at a time."""
    lo = held = 0
    for hi, x in enumerate(lines, 1):
        held += len(x)
        if held > AT_ONCE or hi == len(lines):
            yield nodes[lo:hi], lines[lo:hi]
            lo, held = hi, 0


def linked(lines: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of lines (node, line, short: of at most SHORT characters) that are similar; lines may repeat."""
    count = lines.agg(F.count("short").alias("n"), F.count_if("short").alias("short")).first()
    buckets = buckets_for(BANDS * (count.n + count.short))

    def posted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Combiner(buckets)
        for t in in_slices(batches, "line"):
            for nodes, some in parts(t.column("node").to_pylist(), t.column("line").to_pylist()):
                short = [i for i, x in enumerate(some) if len(x) <= SHORT]
                for width, own, of in ((WIDTH, nodes, some), (SHORT_WIDTH, [nodes[i] + 1 for i in short], [some[i] for i in short])):
                    if own:
                        ids = np.array(own, np.int64)
                        signature, filled = signatures(of, width)
                        out.add(np.repeat(ids, BANDS), band_keys(signature, width).ravel())
                        out.describe(ids, np.full(len(ids), SIZE), sketches(signature, filled))
            yield from out.batches()
        yield from out.batches(last=True)

    def fetch(nodes: DataFrame) -> DataFrame:
        """The lines of the nodes, of both kinds, each once, with the width of its shingles before it."""
        wanted = keys_hint(stage(nodes.select(F.expr("node & ~1L").alias("even"), F.col("node").alias("wanted")), "wanted"))
        found = lines.join(wanted, F.col("node") == F.col("even")).groupBy(F.col("wanted").alias("node")).agg(F.first("line").alias("line"))
        width = F.when(F.expr("node & 1L") == 0, F.lit(bytes([WIDTH]))).otherwise(F.lit(bytes([SHORT_WIDTH])))
        return found.select("node", F.concat(width, F.col("line").cast("binary")).alias("items"))

    roots = link(lines.select("node", "line").mapInArrow(posted, POSTINGS_DDL), None, fetch, percent, Sketches, SKETCH)
    even = lambda c: F.expr(f"{c} & ~1L")
    return roots.select(even("node").alias("a"), even("root").alias("b"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """Keep one line of each component of similar lines in the whole corpus: >= percent per cent of
    shingles of 8 characters, or of 3 for two lines of at most SHORT characters.

    Returns one row per row of docs: id_col, n_lines long (\\n-split), n_dropped long, kept_bytes long (UTF-8 of the kept
    lines joined by \\n), dropped array<int> (their line numbers from 0). The line that stays is the first by id, hash of
    the text, place in the scan and line number, so of rows with one id and text it is one of them. `without_lines` makes
    the texts.

    Blank lines always stay and link nothing. Null text: no lines; empty text: one blank line. Null ids come last in the
    order. Repeated rows keep their own result: the first keeps its lines, the others lose them. Lines shorter than a
    shingle are one shingle. Other columns are ignored, whatever their names. An empty table gives an empty table.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text"))
    per_row = [("row", pa.int64()), ("n_lines", pa.int64()), ("line_bytes", pa.list_(pa.int32())), ("nodes", pa.list_(pa.int64()))]
    per_line = [("node", pa.int64()), ("line", pa.string()), ("short", pa.bool_())]

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each row of docs, and one for each line, once a task as far as the task remembers."""
        at, seen = TaskContext.get().partitionId() << 40, set()
        for t in in_slices(batches, "text"):
            texts = t.column("text").to_pylist()
            split = [x.split("\n") if x is not None else [] for x in texts]
            flat = [x for of in split for x in of]
            folded = [f for x in texts if x is not None for f in folded_lines(x)]
            nodes = [node_of(f) if f else None for f in folded]
            offsets = np.cumsum([0, *map(len, split)]).astype(np.int32)
            sizes = pa.array([len(x) if x.isascii() else len(x.encode("utf-8", "surrogatepass")) for x in flat], pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, x) for x in (sizes, pa.array(nodes, pa.int64()))]
            own = [pa.array(range(at, at + len(split)), pa.int64()), pa.array(map(len, split), pa.int64()), *lists]
            at += len(split)
            if len(seen) > SEEN:
                seen.clear()
            new = {n: f for n, f in zip(nodes, folded, strict=True) if n is not None and n not in seen}
            seen.update(new)
            names = [*t.schema.names[:2], *[k for k, _ in (*per_row, *per_line)]]
            yield pa.RecordBatch.from_arrays([t.column("id"), t.column("key"), *own, *[pa.nulls(t.num_rows, k) for _, k in per_line]], names=names)
            empty = [pa.nulls(len(new), c.type) for c in (t.column("id"), t.column("key"), *own)]
            short = pa.array([len(f) <= SHORT for f in new.values()], pa.bool_())
            yield pa.RecordBatch.from_arrays([*empty, pa.array(new, pa.int64()), pa.array(new.values(), pa.string()), short], names=names)

    ddl = f"id {rows.schema['id'].dataType.simpleString()}, key long, row long, n_lines long, line_bytes array<int>, nodes array<long>, node long, line string, short boolean"
    both = stage(rows.mapInArrow(scanned, ddl), "lines")
    at = both.filter("row is not null").drop(*[k for k, _ in per_line])
    links = linked(both.filter("node is not null").select(*[k for k, _ in per_line]), percent)
    roots = connected_components(links)

    lines = at.select("id", "key", "row", F.posexplode("nodes").alias("line", "node")).filter("node is not null")
    place = F.struct(F.col("id").isNull().alias("last"), "id", "key", "row", "line")
    firsts = lines.groupBy("node").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("times"))
    # a node that stands once and is linked with nothing stays: most are so, and they go no further
    firsts = firsts.join(roots, "node", "left").filter("times > 1 or root is not null").withColumn("root", F.coalesce("root", "node"))
    firsts = stage(firsts, "firsts")
    kept = firsts.groupBy("root").agg(F.min("first").alias("kept"), F.sum("times").alias("of")).filter("of > 1")
    again = stage(firsts.join(kept, "root").select("node", "times", F.col("kept.row").alias("r0"), F.col("kept.line").alias("l0")), "again")
    total = at.agg(F.sum("n_lines").alias("n")).first().n or 0
    hot = again.filter(F.col("times") * HOT > total)  # fewer than HOT rows
    slim = lines.select("row", "line", "node")
    later = slim.join(F.broadcast(hot), "node").unionByName(slim.join(F.broadcast(hot.select("node")), "node", "left_anti").join(again, "node"))
    drops = later.filter("row <> r0 or line <> l0").groupBy("row").agg(F.sort_array(F.collect_list("line")).alias("dropped"))
    out = at.join(drops, "row", "left").withColumn("dropped", F.coalesce("dropped", F.array().cast("array<int>")))
    gone = F.aggregate("dropped", F.lit(0).cast("long"), lambda acc, i: acc + F.get("line_bytes", i) + 1)
    every = F.aggregate("line_bytes", F.lit(0).cast("long"), lambda acc, x: acc + x + 1)
    n_dropped = F.size("dropped").cast("long")
    return out.select(F.col("id").alias(id_col), "n_lines", n_dropped.alias("n_dropped"), F.greatest(every - gone - 1, F.lit(0)).alias("kept_bytes"), "dropped")


def without_lines(docs: DataFrame, result: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with the dropped lines taken out of their texts; ids must be unique. Rows without id, null and empty texts
    stay as they are. All columns pass through, whatever their names."""
    names = docs.columns
    inner = docs.toDF(*[f"c{i}" for i in range(len(names))])
    own, text = (F.col(f"c{names.index(c)}") for c in (id_col, text_col))
    joined = inner.join(result.select(F.col(id_col).alias("id"), F.col("dropped").alias("gone")), own == F.col("id"), "left")
    kept = F.filter(F.split(text, "\n", -1), lambda x, i: ~F.array_contains("gone", i))
    whole = F.when(F.size("gone") > 0, F.array_join(kept, "\n")).otherwise(text)
    return joined.select(*[(whole if c == text_col else F.col(f"c{i}")).alias(c) for i, c in enumerate(names)])
