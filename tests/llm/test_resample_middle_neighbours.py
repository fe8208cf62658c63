"""Importance resampling, fill-in-the-middle and nearest neighbours: parts by brute force, odd rows, recall."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import fill_middle as fim
from tidemark.llm import neighbours, resampling
from tidemark.llm.crc import joined
from tidemark.llm.queries import op13_nearest_neighbours


def features(text, longest=3):
    lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return w, [zlib.crc32(" ".join(w[i : i + n]).encode()) % 10000 for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def test_joined_crcs():
    rng = random.Random(0)
    left = [rng.randbytes(rng.randrange(9)) for _ in range(500)]
    right = [rng.randbytes(rng.choice([0, 1, 5, 63, 64, 65, 127, 1000, 70_000])) for _ in left]
    crcs = [np.array([zlib.crc32(x) for x in side], np.uint32) for side in (left, right)]
    assert joined(*crcs, np.array([len(x) for x in right])).tolist() == [zlib.crc32(a + b) for a, b in zip(left, right, strict=True)]


@pytest.mark.parametrize("piece", [1_000_000, 40, 7])
def test_features_of_texts_in_pieces(monkeypatch, piece):
    monkeypatch.setattr(resampling, "PIECE", piece)
    monkeypatch.setattr(resampling.pieces, "__defaults__", (piece,))
    rng = random.Random(1)
    texts = [None, "", " ", "a", "A b", "é日本 x,y-z_9 k", "w" * 200 + " q " + "z" * 70]
    texts += [" ".join(rng.choices(["a", "bb", "ccc", "Dé", "1", "x" * 70], k=rng.randrange(1, 60))) for _ in range(80)]
    found, total = resampling.Features(), np.zeros(10_000, np.int64)
    data = [t if t is None else t.encode() for t in texts]
    found.count(data, total)
    want = [features(t) for t in texts]
    assert total.tolist() == np.bincount([b for _, f in want for b in f], minlength=10_000).tolist()
    gains = np.random.default_rng(0).integers(-9000, 9000, 10_000)
    n, weight = found.weigh(data, gains)
    assert n.tolist() == [len(w) for w, _ in want]
    assert weight.tolist() == [int(sum(gains[b] for b in f)) for _, f in want]


def test_resample_odd_rows(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(50)]
    texts = [None, "", "..", "one two", *[" ".join(rng.choices(words, k=30)) for _ in range(60)], "long " * 300_000]
    rows = [(i, t, "e", i) for i, t in enumerate(texts)] + [(10, texts[10], "e", 1), (None, texts[12], None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string, extra long")
    target = spark.createDataFrame([("w1 w2 w3 w4",), (None,)], "text string")
    got = resampling.resample(docs, target, percent=20, carry=("extra", "score")).collect()
    assert len(got) == len(rows) and got[0].asDict().keys() == {"doc_id", "extra", "n_words", "n_features", "weight", "score", "rank"}
    all_features = [features(t)[1] for _, t, _, _ in rows]
    s, t = (np.bincount([b for f in side for b in f], minlength=10_000) for side in (all_features, [features("w1 w2 w3 w4")[1]]))
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.sum() + 10_000) / ((s[b] + 1) * (t.sum() + 10_000)))) for b in range(10_000)]
    want = {}
    for (i, _, _, _), f in zip(rows, all_features, strict=True):
        weight = int(sum(gain[b] for b in f))
        h = int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
        want.setdefault(i, []).append((len(f), weight, None if i is None else weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    assert all((r.n_features, r.weight, r.score) in want[r.doc_id] for r in got)
    able = sorted(((r.score, r.doc_id) for r in got if r.doc_id is not None and r.n_words >= 20), key=lambda x: (-x[0], x[1]))
    assert [(r.score, r.doc_id) for r in sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])] == able[: 20 * len(able) // 100]
    assert resampling.resample(docs.limit(0), target).count() == 0
    assert resampling.resample(docs, target.limit(0)).count() == len(rows)


def test_cuts_by_runs():
    rng = random.Random(3)
    for _ in range(500):
        text = "".join(rng.choices("ab é日𝒳 \n\t,", k=rng.randrange(40)))
        data = np.frombuffer(text.encode(), np.uint8)
        begin = [m.start() for m in re.finditer(r"[^\x20\x09-\x0d]+", text)]
        chars = np.sort([rng.randrange(len(text) + 1) for _ in range(2)])
        words = np.sort([rng.randrange(len(begin) + 1) for _ in range(2)])
        for block in (1_000_000, 4, 5, 16):
            assert fim.char_bytes(data, chars, block).tolist() == [len(text[:c].encode()) for c in chars]
            assert fim.count_words(data, block) == len(begin)
            assert fim.word_bytes(data, words, block).tolist() == [0 if w == 0 else len(text[: begin[w]].encode()) if w < len(begin) else len(data) for w in words]


@pytest.mark.parametrize("unit", ["chars", "words"])
def test_fill_middle_odd_rows(spark, unit):
    rng = random.Random(4)
    texts = [None, "", "a", "has <M> in it", "<" * 50, ">" * 50, "S>" * 40, "é日𝒳 " * 400_000, *["".join(rng.choices("ab é日𝒳<S>M\n", k=rng.randrange(1, 80))) for _ in range(80)]]
    rows = [(i, t, "form", i) for i, t in enumerate(texts)] + [(9, texts[9], "x", 1), (None, "no id", "x", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, form string, row long")
    made = fim.fill_middle(docs, unit=unit)
    assert sorted(made.columns) == ["doc_id", "form", "middle_chars", "n", "output", "prefix_chars", "row", "text"]
    got = made.withColumn("again", fim.restored(F.col("output"), F.col("form"))).collect()
    assert len(got) == len(rows)
    for r in got:
        text = r.text or ""
        assert r.again == text
        h = [int(hashlib.sha256(f"1:{r.doc_id}".encode()).hexdigest()[8 * i : 8 * i + 8], 16) for i in range(4)]
        n = len(text) if unit == "chars" else len(re.findall(r"[^\x20\x09-\x0d]+", text))
        assert r.n == n
        if r.doc_id is None or not text or any(m in text for m in fim.MARKS) or h[2] % 100 >= 90:
            assert (r.form, r.output, r.prefix_chars, r.middle_chars) == ("plain", text, None, None)
            continue
        assert r.form == ("spm" if h[3] % 100 < 20 else "psm")
        if unit == "chars":
            a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
            pre, mid, suf = text[:a], text[a:b], text[b:]
            assert r.output == (f"<S>{suf}<P>{pre}<M>{mid}" if r.form == "spm" else f"<P>{pre}<S>{suf}<M>{mid}")
            assert (r.prefix_chars, r.middle_chars) == (len(pre), len(mid))
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert fim.fill_middle(docs.limit(0), unit=unit).count() == 0


def brute(rows, k=5):
    """For each id divisible by 50, the k nearest others by cosine in double precision."""
    ids, vec = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64)
    length = np.sqrt((vec * vec).sum(axis=1))
    out = {}
    for i in np.flatnonzero(ids % 50 == 0):
        score = (vec[i] * vec).sum(axis=1) / (length[i] * length)
        score[ids == ids[i]] = -np.inf
        best = np.lexsort((ids, -score))[: min(k, len(ids) - 1)]
        out[int(ids[i])] = [(int(ids[j]), float(score[j])) for j in best]
    return out


def held(got, want):
    """Whether scores and orders are right; returns the recall."""
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append(r)
    assert by.keys() == want.keys()
    hits = 0
    for q, rows in by.items():
        rows.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == list(range(1, len(want[q]) + 1))
        assert [(r.score, -r.vec_id) for r in rows] == sorted(((r.score, -r.vec_id) for r in rows), reverse=True)
        exact = dict(want[q])
        assert all(abs(r.score - exact[r.vec_id]) < 1e-12 for r in rows if r.vec_id in exact)
        hits += sum(r.vec_id in exact for r in rows)
    return hits / sum(map(len, want.values()))


@pytest.mark.parametrize("sf", ["0.01", "0.1"])
def test_recall_on_whole_tables(spark, sf):
    rows = spark.read.parquet(f"/root/testdata/sf{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    assert held(op13_nearest_neighbours(spark, f"/root/testdata/sf{sf}").collect(), brute(rows)) >= 0.97


def test_recall_over_many_shards_with_copies(spark, monkeypatch):
    for name, value in (("SHARD_LEAST", 300), ("SHARD_ROOT", 5)):
        monkeypatch.setattr(neighbours, name, value)
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(20, 24))
    vec = (centre[rng.integers(0, 20, 4000)] + rng.normal(size=(4000, 24)) * 0.4).astype(np.float32)
    vec[1500:2700] = vec[0]  # a third are copies
    rows = [(i, v.tolist()) for i, v in enumerate(vec)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    index = neighbours.build_index(df, "vec_id", "embedding")
    assert index.select("shard").distinct().count() >= 5
    assert index.count() == 2800 and index.agg(F.max(F.size("ids"))).first()[0] == 6
    got = neighbours.search_index(index, df.filter("vec_id % 50 = 0"), "vec_id", "embedding").collect()
    assert held(got, brute(rows)) >= 0.97
    assert [r.vec_id for r in sorted((r for r in got if r.query_id == 2000), key=lambda r: r["rank"])] == [0, 1500, 1501, 1502, 1503]


def test_neighbours_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [nan, 1.0]), (5, [1.0, inf]), (6, [1.0, None]), (7, []), (None, [1.0, 0.0]), (50, [0.0, 1.0]), (50, [0.0, 1.0]), (8, [1e200, 1e200]), (9, [1.0, 2.0, 3.0]), (100, [1.0, 2.0, 4.0]), (150, [0.0, 0.0]), (200, None)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "id long, v array<double>, rank string, shard long")
    index = neighbours.build_index(df, "id", "v")
    got = neighbours.search_index(index, df.filter("id % 50 = 0"), "id", "v").collect()
    found = {q: [(r.vec_id, round(r.score, 12)) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q] for q in {r.query_id for r in got}}
    half = round(math.sqrt(0.5), 12)
    assert found == {0: [(1, 1.0), (8, half), (50, 0.0)], 50: [(8, half), (0, 0.0), (1, 0.0)], 100: [(9, round(17 / math.sqrt(14 * 21), 12))]}
    assert neighbours.search_index(neighbours.build_index(df.limit(0), "id", "v"), df, "id", "v").count() == 0
    assert neighbours.search_index(index, df.limit(0), "id", "v").count() == 0
