"""Operators on pairs against brute force over a whole small table."""

import random
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np

import __spark_entry__
from tidemark.llm import setjoin
from tidemark.llm.hashing import mix
from tidemark.llm.ngram_join import jaccard_groups, jaccard_links
from tidemark.operators.components import connected_components

SF = "/root/testdata/sf0.01"


def components(ids, links):
    up = {i: i for i in ids}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    return {i: top(i) for i in ids}


def sets_of(rows):
    out = {}
    for r in rows:
        w = (r.text or "").encode().lower().split()
        out[r.doc_id] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())
    return out


def test_ngram_jaccard_join(spark):
    sets = sets_of(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    holders, shared = defaultdict(list), Counter()
    for i in sorted(sets):
        for x in sets[i]:
            holders[x].append(i)
    for h in holders.values():
        shared.update(combinations(h, 2))
    links = [(a, b) for (a, b), n in shared.items() if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n)]
    assert len(links) > 20
    want = components(sets, links)
    got = __spark_entry__.queries()["op1_ngram_jaccard_join"](spark, SF).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (len(sets[i]), want[i]) for i in sets}
    assert len(got) == len(sets)


def test_every_key_through_tiles(spark, monkeypatch):
    """The ways for large keys, with blocks of a few sets: chains of near copies whose ends are not similar."""
    monkeypatch.setattr(setjoin, "BLOCK_ITEMS", 2_000)
    monkeypatch.setattr(setjoin, "TOGETHER", 500)
    monkeypatch.setattr(setjoin, "SMALL", 6)
    rng = random.Random(2)
    rows, now = [], []
    for i in range(240):
        if i % 40 == 0:
            now = [f"w{rng.randrange(5_000)}" for _ in range(rng.choice([30, 120, 400]))]
        now = list(now)
        for _ in range(max(1, len(now) // rng.choice([40, 60, 90]))):
            now[rng.randrange(len(now))] = f"w{rng.randrange(5_000)}"
        rows.append((i, " ".join(now)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = sets_of(docs.collect())
    links = [(a, b) for a, b in combinations(sets, 2) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = components(sets, links)
    assert len(set(want.values())) < 200
    assert {r.doc_id: r.component_id for r in jaccard_groups(docs).collect()} == want


def test_every_link(spark):
    rng = random.Random(4)
    rows, now = [(900, None), (901, " "), (None, "a b c d e f g")], []
    for i in range(60):
        if i % 20 == 0:
            now = [f"w{rng.randrange(5_000)}" for _ in range((5, 60, 200)[i // 20])]
        elif i % 3:
            now = list(now)
            now[rng.randrange(len(now))] = f"w{rng.randrange(5_000)}"
        rows.append((i, " ".join(now)))
    docs = spark.createDataFrame([*rows, rows[-1]], "doc_id long, text string")
    sets = sets_of(docs.filter("doc_id is not null").collect())
    least = {}
    for i in sorted(sets):
        least.setdefault(frozenset(sets[i]), i)
    want = Counter()
    for i, j in combinations(sorted(sets), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
            want[tuple(sorted((least[frozenset(sets[i])], least[frozenset(sets[j])])))] += 1
    got = {(r.a, r.b): r.links for r in jaccard_links(docs).collect()}
    assert got == want and sum(a != b for a, b in got) > 50
    assert jaccard_links(docs.limit(0)).count() == 0


def test_small_and_large_tiles_alike(monkeypatch):
    """Pairs that pass within tiles, bounded together or a row at a time: the same, and all that are similar."""
    rng = np.random.default_rng(3)
    sets, now = [], None
    for i in range(120):
        if i % 12 == 0:
            now = rng.integers(0, 1 << 63, rng.integers(40, 90), dtype=np.uint64)
        sets.append(np.unique(np.r_[now[rng.integers(0, 9) :], rng.integers(0, 1 << 63, rng.integers(0, 9), dtype=np.uint64)]))
    tile = np.repeat([0, 1], 60)
    t = {"tile": tile, "side": np.tile(np.repeat([0, 1], 30), 2) * (tile == 0), "root": np.arange(120) // 2, "n": np.array([len(x) for x in sets]), "bits": np.array([setjoin.bitmap(x) for x in sets], object)}
    got = []
    for small in (64, 1):
        monkeypatch.setattr(setjoin, "SMALL", small)
        got.append({(min(a, b), max(a, b)) for i, j in setjoin.passing(t, 80, setjoin.Bitmaps) for a, b in zip(i.tolist(), j.tolist(), strict=True)})
    may = {(a, b) for a, b in combinations(range(120), 2) if tile[a] == tile[b] and t["root"][a] != t["root"][b] and (tile[a] or t["side"][a] != t["side"][b])}
    want = {(a, b) for a, b in may if setjoin.similar(sets[a], sets[b], 80)}
    assert want <= got[0] <= got[1] <= may and len(want) > 100  # in a large tile bitmaps are folded to the least size


def test_small_groups_are_single_tiles(spark):
    """No member of a group that fits one tile is given out again for each band beside its own, and nothing is joined."""
    rng = random.Random(5)
    rows = [(lead, 100 * lead + i, i % 3, rng.randrange(50, 200), b"") for lead in range(30) for i in range(rng.randrange(2, 20))]
    rows += [(99, 10_000 + i, i, 9_000 if i % 2 else 10_000, b"") for i in range(150)] + [(98, 20_000 + i, i, 10 + i, b"") for i in range(80)]
    tiled = setjoin._tiled(spark.createDataFrame(rows, setjoin.MEMBERS_DDL), 80)
    got = Counter(r.lead for r in tiled.collect())
    of = Counter(r[0] for r in rows)
    assert {k: n for k, n in got.items() if k < 98} == {k: n for k, n in of.items() if k < 98}
    assert got[99] > of[99] and got[98] > of[98]  # too large, or of unlike sizes
    small = setjoin._tiled(spark.createDataFrame(rows, setjoin.MEMBERS_DDL).filter("lead < 98"), 80)
    assert "Exchange" not in small._jdf.queryExecution().executedPlan().toString()


def test_stars_hold_every_pair_of_a_key(spark, monkeypatch):
    """Postings in many chunks, some nodes given out twice: each member of a key meets one lead, with `more` unless the key
    has these two members alone, so that a group holds each pair of its keys that has not been compared with the lead."""
    monkeypatch.setattr(setjoin, "CHUNK", 50)
    rng = np.random.default_rng(6)
    key = mix(np.r_[rng.integers(0, 150, 400), rng.integers(1_000, 1_004, 200), np.repeat(np.arange(2_000, 2_100), 2)].astype(np.uint64))
    node = np.r_[rng.integers(0, 80, 600), rng.integers(100, 140, 200)]
    order = rng.permutation(len(key))
    batches, out = [], setjoin.Combiner(8)
    for at in np.array_split(order, 60):
        out.add(node[at], key[at])
        batches += out.batches()
    batches += out.batches(last=True)
    assert len(batches) > 5
    postings = spark.createDataFrame([tuple(r.values()) for b in batches for r in b.to_pylist()], setjoin.POSTINGS_DDL)
    every = postings.groupBy("bucket").applyInArrow(lambda rows: setjoin._led(rows, 0), setjoin.LED_DDL)
    rows = [(r.a, r.b, r.more) for r in setjoin._stars(every).collect()]
    got = {(a, b): more for a, b, more in rows}
    assert len(got) == len(rows) and all(a != b for a, b in got)
    members = defaultdict(set)
    for k, n in zip(key.tolist(), node.tolist(), strict=True):
        members[k].add(n)
    pairs = {(min(p), max(p)) for m in members.values() for p in combinations(m, 2)}
    assert {(min(p), max(p)) for p in got} <= pairs
    for m in members.values():
        if len(m) == 2:
            a, b = m
            assert (a, b) in got or (b, a) in got
        elif len(m) > 2:
            assert any(all(got.get((lead, x)) for x in m - {lead}) for lead in m)
    assert not all(got.values())


def test_components_of_any_shape(spark):
    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(400)] + [(1_000, 1_001 + i) for i in range(300)] + [(5_000 + rng.randrange(300), 5_000 + rng.randrange(300)) for _ in range(200)] + [(7, 7), (9_000, 9_000)]
    df = spark.createDataFrame([(b, a) if rng.random() < 0.5 else (a, b) for a, b in edges], "a long, b long").repartition(7)
    ids = {x for a, b in edges if a != b for x in (a, b)}
    assert {r.node: r.root for r in connected_components(df).collect()} == components(ids, [e for e in edges if e[0] != e[1]])
    assert connected_components(df.limit(0)).count() == 0


def family(rng, base, n, edits):
    """n texts of base's words with so many of them replaced, each in its own places."""
    out = []
    for _ in range(n):
        words = list(base)
        for k in rng.sample(range(len(words)), edits):
            words[k] = f"x{rng.randrange(1 << 40)}"
        out.append(" ".join(words))
    return out


def test_near_copies_stand_once_not_for_each_lead(spark, monkeypatch):
    """A family whose sets share keys of many leads: rows that are dealt into tiles, for two sizes of it."""
    rng, seen = random.Random(7), []
    across = setjoin._across
    monkeypatch.setattr(setjoin, "_across", lambda sized, *rest: seen.append((sized.count(), sized.select("node").distinct().count())) or across(sized, *rest))
    base = [f"w{i}" for i in range(150)]
    for n in (200, 400):
        texts = family(rng, base, n, 5)
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        sets = sets_of(docs.collect())
        links = [(a, b) for a, b in combinations(sets, 2) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
        assert {r.doc_id: r.component_id for r in jaccard_groups(docs).collect()} == components(sets, links)
    assert all(rows < 4 * nodes for rows, nodes in seen) and len(seen) == 2, seen


def test_absorbed_groups_keep_every_pair(spark):
    """Nested, overlapping and unlike groups: each old pair is within a new group, and pairs do not get more."""
    rng = random.Random(8)
    groups = {}
    for k in range(5):
        pool = range(1_000 * k, 1_000 * k + 300)
        groups[10 * k] = set(rng.sample(pool, 250))
        for j in range(1, 8):
            some = rng.sample(sorted(groups[10 * k]), rng.choice([20, 100, 200]))
            groups[10 * k + j] = {*some, *rng.sample(range(100_000), rng.choice([0, 0, 1, 3, 60]))}
    hub = set(range(200_000, 200_100))  # many groups, each with other new ones
    groups[900] = hub
    for j in range(1, 40):
        groups[900 + j] = {*rng.sample(sorted(hub), 60), *range(300_000 + 10 * j, 300_000 + 10 * j + 9)}
    members = spark.createDataFrame([(g, x) for g, xs in groups.items() for x in xs], "lead long, node long")
    new = defaultdict(set)
    for r in setjoin._absorbed(members).collect():
        new[r.lead].add(r.node)
    pairs = lambda gs: {p for xs in gs.values() for p in combinations(sorted(xs), 2)}
    work = lambda gs: sum(len(xs) * (len(xs) - 1) // 2 for xs in gs.values())
    led = lambda gs: {g: {g, *xs} for g, xs in gs.items()}
    assert pairs(led(groups)) <= pairs(led(new))
    assert work(new) < work(groups) and len(new) < len(groups) - 10
    empty = setjoin._absorbed(members.limit(0))
    assert empty.count() == 0 and set(empty.columns) == {"lead", "node"}
