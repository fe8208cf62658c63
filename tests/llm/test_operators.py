"""The operators on small tables: odd rows, and brute force."""

import random
import re
import time
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tidemark.llm import quality_rules as quality
from tidemark.llm import setjoin, sharding
from tidemark.llm.decontam import contaminated
from tidemark.llm.license_scan import TEMPLATES, license_scan
from tidemark.llm.line_dedup import Sketches, char_shingles, fold, folded_lines, line_dedup, without_lines
from tidemark.llm.mixing import mix_sources, taken
from tidemark.llm.ngram_join import jaccard_groups, tile_keys
from tidemark.llm.quality_rules import quality_rules
from tidemark.llm.sharding import shard
from tidemark.llm.token_count import count_pieces, pre_tokens, token_counts
from tidemark.llm.toxicity import Model
from tidemark.llm.url_filter import url_filter

DDL = "doc_id long, text string, lang string, source string, node string, key string, n_tokens string"


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(400)]
    base = " ".join(rng.choices(words, k=300))
    near = base.split()
    near[7] = "other"
    texts = [None, "", "  \n ", "one two", "One TWO", base, base, " ".join(near), "tail " * 30_000 + base, "a  b\n\nc\n", "x y\x1cz é日"]
    rows = [(i, t, "en", "src1", "n", "k", "t") for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[5], (None, base, None, None, None, None, None)], DDL)


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def test_jaccard_groups(spark, odd):
    got = jaccard_groups(odd).collect()
    assert len(got) == odd.count()
    by = {r.doc_id: (r.n_shingles, r.component_id) for r in got}
    assert by[0] == (0, 0) and by[1] == (0, 1) and by[3] == (1, 3) and by[4] == (1, 3)
    assert by[5][1] == by[6][1] == by[7][1] == by[8][1] == 5  # a very long tail of one word adds five shingles
    assert by[None][1] is None
    assert all(r.n_shingles == len(shingles(t.text)) for r in got for t in odd.filter(F.col("doc_id").eqNullSafe(r.doc_id)).limit(1).collect())
    assert jaccard_groups(odd.limit(0)).count() == 0


def test_similar_sets_share_a_key():
    rng = np.random.default_rng(0)
    for n in [1, 2, 3, 5, 8, 9, 13, 14, 20, 40, 100, 333, 1000] * 30:
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        drop = rng.integers(0, n // 5 + 1)
        b = np.unique(np.r_[rng.permutation(a)[drop:], rng.integers(0, 1 << 63, rng.integers(0, n // 5 + 1), dtype=np.uint64)])
        both = len(np.intersect1d(a, b))
        if 100 * both >= 80 * (len(a) + len(b) - both):
            assert np.intersect1d(tile_keys(a, 80), tile_keys(b, 80)).size
            bits = [np.frombuffer(setjoin.bitmap(x), np.uint8) for x in (a, b)]
            assert setjoin.bound(bits[0], len(a), bits[1], len(b)) >= both == setjoin.overlap(a, b)
            maps = setjoin.Bitmaps([x.tobytes() for x in bits], np.array([len(a), len(b)]), 80)
            assert maps.upper(np.array([0]), np.array([1]))[0] == maps.among(np.array([0, 1]))(0, np.array([1]))[0] == setjoin.bound(bits[0], len(a), bits[1], len(b))


def test_token_counts(spark, odd):
    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    got = token_counts(odd, path).collect()
    texts = {r.doc_id: r.text or "" for r in odd.collect()}
    assert len(got) == odd.count()
    assert all((r.n_bytes, r.n_tokens) == (len(texts[r.doc_id].encode()), len(sp.encode(texts[r.doc_id]))) for r in got)
    assert token_counts(odd.limit(0), path).count() == 0


def test_token_counts_of_any_text():
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(7)
    alphabet = [" ", "\u2581", "\n", "a", "b", "the", " of", "<s>", "</s>", "<unk>", "\t", "é", "日", "\u00a0", "\u3000", "ﬁ", "12", ".", "--", "\r", "\u0301", "-" * 60]
    for _ in range(20_000):
        t = "".join(rng.choices(alphabet, k=rng.randrange(1, 12)))
        assert sum(count_pieces(sp, pre_tokens(t))) == len(sp.encode(t)), t


def test_token_counts_of_a_whole_table(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(-i, x) for i, x in enumerate(["-" * 60, "a " + "-" * 60 + "\n" + "-" * 60, "=" * 5_000, "x\u2581 \u2581 y"], 1)], docs.schema)
    docs = docs.unionByName(odd)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    got = token_counts(docs, path).collect()
    assert len(got) == len(texts) and all((r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n := len(sp.encode(texts[r.doc_id])), n > 4096) for r in got)


def test_toxicity_query(spark):
    """Held-out rows are told by their id alone, and scores by the text alone: equal texts have equal ones."""
    import zlib

    import __spark_entry__

    got = __spark_entry__.queries()["op3_toxicity"](spark, "/root/testdata/sf0.01").collect()
    text = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()}
    assert sorted(r.doc_id for r in got) == sorted(text)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    by_text = {}
    assert all(by_text.setdefault(text[r.doc_id], r.score) == r.score for r in got)


def test_toxicity_on_held_out_rows(spark):
    """Against the labels of the rows that the model has not seen. The table has some 400 toxic rows to learn from; with
    1,500 of them nearly all are found, with these 57 of 97, and
    15 of 728 clean ones are flagged."""
    import __spark_entry__

    got = __spark_entry__.queries()["op3_toxicity"](spark, "/root/testdata/sf0.1").filter("held_out")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = got.join(labels, "doc_id").select("predicted", "toxic").collect()
    toxic = [r.predicted for r in rows if r.toxic]
    clean = [r.predicted for r in rows if r.toxic == 0]
    assert len(toxic) > 20 and sum(toxic) >= 0.5 * len(toxic) and sum(clean) <= 0.03 * len(clean)


def test_toxicity_learns_and_reads_misspellings():
    rng = random.Random(3)
    clean = [" ".join(rng.choices([f"word{i}" for i in range(60)], k=30)) for _ in range(300)]
    texts = [f"{t} horribleinsult {t}" if i % 3 == 0 else t for i, t in enumerate(clean)]
    scorer = Model().fit(texts, [int(i % 3 == 0) for i in range(300)]).scorer()
    bad, good, none, void = scorer.score([clean[1] + " horribleinsullt", clean[2], None, ""])
    assert bad > 0.5 > good and none == void < 0.5
    assert scorer.score(["word1 " * 100_000 + "horribleinsult"])[0] > 0.5


def test_quality_rules(spark, odd):
    got = quality_rules(odd).collect()
    assert len(got) == odd.count() and all(r.base_failed and not r.kept for r in got if r.n_words < 50)
    assert quality_rules(odd.limit(0)).count() == 0


def test_line_dedup(spark):
    line = "a fairly long line of words that stands in many documents of the corpus, more or less as it is"
    rows = [(1, f"{line}\nown line of one"), (2, f"{line}!\nsome other text"), (3, None), (4, "\n\n"), (None, line), (1, f"{line}\nown line of one")]
    got = line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 6
    first = sorted(r.n_dropped for r in got if r.doc_id == 1)
    assert first == [0, 2] and [r.dropped for r in got if r.doc_id in (2, None)] == [[0], [0]]
    assert line_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_lines_are_folded_and_hashed_alike():
    """A text's lines at once as each by itself: case at the ends of words, blanks of all kinds; shingles of each line once."""
    rng = random.Random(8)
    for letters in ("aB \n ", "aB \n\t\x1f\r\v", "aAΣσςİßǅ' .\n\t\x1c\x85\xa0\u2003\u3000\u0345\ud800"):
        for _ in range(2_000):
            text = "".join(rng.choices(letters, k=rng.randrange(15)))
            assert folded_lines(text) == [fold(x) for x in text.split("\n")]
    lines = ["", "a", "a" * 30, *("".join(rng.choices("abc ", k=rng.randrange(150))) for _ in range(900))]
    widths = [rng.choice([3, 8]) for _ in lines]
    got = Sketches.sets([bytes([w]) + x.encode() for w, x in zip(widths, lines, strict=True)])
    for w, x, have in zip(widths, lines, got, strict=True):
        assert np.array_equal(np.unique(char_shingles([x], w)[0]), have)


def test_line_dedup_ties_and_texts(spark):
    line = "a fairly long line of words that stands in many documents of the corpus, more or less as it is"
    rows = [(1, f"x\n{line}", "p"), (1, f"{line}\ny", "q"), (2, f"{line}.", "r"), (3, "", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _dropped string")
    sides = [sorted(map(str, line_dedup(docs.orderBy(F.desc("_dropped") if k else F.asc("_dropped")).coalesce(1)).collect())) for k in (0, 1)]
    assert sides[0] == sides[1]
    one = docs.filter("_dropped <> 'q'").withColumns({"_id": F.lit(5), "gone": F.lit("g"), "id": F.lit("i")})
    got = {r.doc_id: r for r in without_lines(one, line_dedup(one)).collect()}
    assert [got[k].text for k in (1, 2, 3)] == [f"x\n{line}", "", ""] and got[2]._dropped == "r" and got[2].gone == "g" and got[2]._id == 5


def test_line_dedup_recall(spark):
    """Over all lines of a whole small table, against every pair."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    lines = sorted({fold(x) for r in docs.collect() for x in (r.text or "").split("\n")} - {""})
    sets = {w: dict(zip(lines, Sketches.sets([bytes([w]) + x.encode() for x in lines]), strict=True)) for w in (8, 3)}
    links = set()
    for w in (8, 3):
        some = sorted((x for x in lines if w == 8 or len(x) <= 110), key=lambda x: len(sets[w][x]))
        for j, b in enumerate(some):
            for a in reversed(some[:j]):
                if len(sets[w][a]) < 0.8 * len(sets[w][b]):
                    break
                if setjoin.similar(sets[w][a], sets[w][b], 80):
                    links.add((a, b))
    up = {x: x for x in lines}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in sorted(links):
        a, b = sorted((top(a), top(b)))
        up[b] = a
    seen, want = set(), {}
    for r in sorted(docs.collect(), key=lambda r: r.doc_id):
        for i, x in enumerate((r.text or "").split("\n")):
            if f := fold(x):
                if top(f) in seen:
                    want.setdefault(r.doc_id, set()).add(i)
                seen.add(top(f))
    got = {r.doc_id: set(r.dropped) for r in line_dedup(docs).collect() if r.dropped}
    flat = lambda d: {(k, i) for k, v in d.items() for i in v}
    assert flat(got) <= flat(want) and len(flat(got)) >= 0.98 * len(flat(want)) > 20


def test_line_dedup_of_short_lines(spark):
    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyzñéß"
    lines = ["".join(rng.choices(letters, k=n)) for n in range(30, 121) for _ in range(3)]
    edits = []
    for x in lines:
        at = rng.randrange(len(x))
        edits.append(rng.choice([x[:at] + "0" + x[at + 1 :], x[:at] + "0" + x[at:], x[:at] + x[at + 1 :]]))
    both = [*lines, *edits]

    def like(a, b, width):
        a, b = ({x[i : i + width] for i in range(len(x) - width + 1)} for x in (a, b))
        return 100 * len(a & b) >= 80 * len(a | b)

    links = [(i, j) for j, b in enumerate(both) for i, a in enumerate(both[:j]) if like(a, b, 8) or max(len(a), len(b)) <= 110 and like(a, b, 3)]
    later = {j for _, j in links}
    assert len(later) == len(lines)
    got = {r.doc_id: r.n_dropped for r in line_dedup(spark.createDataFrame(list(enumerate(both)), "doc_id long, text string")).collect()}
    missed = [i for i in got if got[i] != (i in later)]
    assert len(missed) <= 1, missed  # by chance, as the module's head says


def test_url_filter(spark):
    rules = (("allow", "org/"), ("block", "example.org/es/"))
    urls = ["http://A.example.org/es/x?q", "http://b.org", "http://b.org/", None, "nothing", "http://bad.net/1#x"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame([(5, 0, 1), (4, None, None)], "doc_id long, quality int, toxic int")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter(pages, labels, rules).collect()}
    assert got[0] == ("a.example.org", "/es/x", "example.org/es/", "block") and got[1][:3] == ("b.org", "", None)
    assert got[2][2:] == ("org/", "allow") and got[3][:3] == got[4][:3] == ("", "", None) and got[5][1] == "/1"
    assert url_filter(pages.limit(0), labels.limit(0), rules).count() == 0


def test_mixing(spark):
    rows = [(i, "w " * 10, "en", f"s{i % 2}") for i in range(400)] + [(900, None, None, None), (None, "w", "en", "s0")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    mixed = mix_sources(docs, F.lit("d"), share=0.5, epochs=2, weights={"d/en/s0": 3.0})
    times = Counter(r.source for r in taken(mixed).collect())
    assert mixed.count() == docs.count() and times["s0"] + times["s1"] in range(195, 203) and times["s0"] == pytest.approx(150, abs=2)
    assert mix_sources(docs.limit(0), F.lit("d")).count() == 0


def test_mixing_keeps_columns_of_any_name(spark):
    rows = [(i, "w " * 10, "en", "s1", "MINE", "MINE", "MINE", "MINE", "MINE", "MINE") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, l_domain string, _lang string, _whole string, row string, _epoch string, tokens string")
    mixed = taken(mix_sources(docs, F.lit("d"), share=0.5))
    assert mixed.columns == docs.columns and 20 <= mixed.count() <= 25 and {tuple(r[4:]) for r in mixed.collect()} == {("MINE",) * 6}
    assert taken(mix_sources(docs, F.lit("d")), epoch="_epoch").select("_epoch").distinct().count() == 1


def test_mixing_by_brute_force(spark):
    """Budgets over the tree, with a shortage that a sibling domain makes up, and the prefix that each leaf takes."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang", "source")
    domain = F.when(F.col("source") == "src3", "scarce").when(F.col("source") < "src4", "a").otherwise("b")
    weights = {"scarce": 40.0, "a": 2.0, "a/de": 3.0, "b/en/src5": 0.5}
    share, epochs, seed = 0.6, 2, 11
    rows = docs.select("doc_id", "text", domain.alias("d"), "lang", "source", *[F.expr(f"shiftrightunsigned(xxhash64({seed}, {e}, doc_id, xxhash64(text)), 2)").alias(f"p{e}") for e in range(epochs)]).collect()
    leaf = {}
    for r in rows:
        leaf.setdefault((r.d, r.lang, r.source), []).append((r.p0, r.p1, r.doc_id, len((r.text or "").encode().split())))
    tokens = {k: sum(x[3] for x in v) for k, v in leaf.items()}

    def budgets(paths, depth, given):
        if depth == 3:
            return {paths[0]: given}
        kids = {}
        for p in paths:
            kids.setdefault(p[: depth + 1], []).append(p)
        room = {k: sum(tokens[p] for p in v) * epochs for k, v in kids.items()}
        w = {k: weights.get("/".join(k), 1.0) for k in kids}
        part, left, open_ = {}, given, set(kids)
        while open_:
            full = [k for k in open_ if room[k] <= left * w[k] / sum(w[x] for x in open_)]
            if not full:
                part.update({k: left * w[k] / sum(w[x] for x in open_) for k in open_})
                break
            k = min(full, key=lambda x: room[x] / w[x])
            part[k] = room[k]
            left -= room[k]
            open_.remove(k)
        return {p: b for k, v in kids.items() for p, b in budgets(v, depth + 1, part[k]).items()}

    want = Counter()
    for path, b in budgets(sorted(leaf), 0, share * sum(tokens.values())).items():
        whole = min(epochs, int(b // tokens[path] + 1e-9))
        for x in leaf[path]:
            want[x[2]] += whole
        left = b - whole * tokens[path]
        for x in sorted(leaf[path], key=lambda x: x[min(whole, epochs - 1)]) if whole < epochs else ():
            left -= x[3]
            if left < -1e-6:
                break
            want[x[2]] += 1
    got = Counter({r.doc_id: r.n for r in taken(mix_sources(docs, domain, share, epochs, weights, seed)).groupBy("doc_id").agg(F.count("*").alias("n")).collect()})
    assert got == +want


def test_contaminated_in_any_script(spark):
    items = {1: "某农夫有十二个苹果他把五个苹果给了玛丽然后走了三公里回家去了", 2: "The Great War Of The Red Rose And The White Rose Began", 3: "Maria Petra Otto Karl Anna Berta Ida Max Paul Hugo Emil", 4: "10 20 30 40 50 60 70 80 90"}
    docs = spark.createDataFrame([(k, f"so , {x} , it is") for k, x in items.items()] + [(9, "nothing of these")], "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r.verbatim for r in contaminated(docs, spark.createDataFrame(list(items.items()), "item_id long, text string")).collect()}
    assert got == {(k, k): True for k in items}


def test_contaminated_on_a_whole_table(spark):
    """Every item of the benchmark that stands word for word in a document is found, whatever its case, and every item
    with other numbers; what is found holds half of an item's words in order, or thirteen."""
    sf = "/root/testdata/sf0.01"
    docs, bench = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    split = lambda t: re.findall(r"\d+(?:[.,]\d+)*|[^\W\d_]+", (t or "").upper().lower())
    items = {r.item_id: split(r.text) for r in bench.collect()}
    found = {(r.doc_id, r.item_id) for r in contaminated(docs, bench).collect()}
    want = {(r.doc_id, i) for r in docs.collect() for whole in (f" {' '.join(split(r.text))} ",) for i, x in items.items() if f" {' '.join(x)} " in whole}
    assert want and want <= found
    rng = random.Random(8)
    changed = bench.collect()
    new = [(10_000 + r.item_id, re.sub(r"\d+", lambda m: str(int(m[0]) + rng.randrange(5, 90)), r.text)) for r in changed if r.text]
    again = {(r.doc_id - 10_000, r.item_id) for r in contaminated(spark.createDataFrame(new, "doc_id long, text string"), bench).collect()}
    assert {i for i, _ in again} >= {r.item_id for r in changed if r.text} and len({(i, j) for i, j in again if i == j}) >= 0.98 * len(new)


def test_contaminated(spark):
    q = "a farmer has 12 apples and gives 5 apples to Maria before she walks 3 km home with the rest of them"
    other = q.replace("12", "31").replace("5", "9").replace("Maria", "Petra").replace("3 km", "7 miles")
    torn = q.replace("12 apples", "8 apples").replace("5 apples", "8 apples")
    rows = [(1, f"before {q} after"), (2, f"before {other} after"), (3, torn), (4, None), (5, "nothing of it at all in here, only words"), (None, q)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(7, q), (8, None), (9, "too short")], "item_id long, text string")
    got = {r.doc_id: r.verbatim for r in contaminated(docs, bench).collect()}
    assert got[1] is True and got[2] is False and got[None] is True and 4 not in got and 5 not in got
    assert contaminated(docs, bench.limit(0)).count() == 0 == contaminated(docs.limit(0), bench).count()


def test_contaminated_in_any_case(spark):
    q = "Then Maria Straße and Petra Lindt met Karl Ebert in Bonn , and Otto Kern gave Maria 12 apples for the Long Walk Home"
    numbers = "4 8 15 16 23 42 108 316 1000 2000"
    shout = "THE WHOLE ITEM STANDS IN CAPITALS FROM ITS FIRST WORD TO THE LAST ONE"
    rows = [q, q.upper(), q.lower(), q.replace("12", "31").upper(), numbers, shout, shout.lower(), numbers.replace("15", "17"), "NOTHING OF ALL THAT STANDS IN THIS ROW , NOT A LINE OF IT AT ALL"]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    bench = spark.createDataFrame([(7, q), (8, numbers), (9, shout)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.coverage, r.verbatim) for r in contaminated(docs, bench).collect()}
    assert got == {(0, 7): (1.0, True), (1, 7): (1.0, True), (2, 7): (1.0, True), (3, 7): (1.0, False), (4, 8): (1.0, True), (5, 9): (1.0, True), (6, 9): (1.0, True)}


def test_contaminated_despite_a_clash(spark):
    q = "a farmer has 12 apples and gives 5 apples to Maria before she walks 3 km home with the rest of them"
    torn = q.replace("12 apples", "8 apples").replace("5 apples", "8 apples")
    twice = "the clerk counts 7 boxes in the hall and then finds 7 more of these in the yard behind it"
    long = f"Anna said that {q} and then Maria went on to the market with the others as Anna had asked her to"
    rows = [torn, twice.replace("7 boxes", "8 boxes").replace("7 more", "9 more"), long.replace("Anna said", "Petra said")]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate([q, twice, long])), "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.coverage, r.verbatim) for r in contaminated(docs, bench).collect()}
    assert got[0, 0] == (1.0, False) and got[1, 1][0] > 0.7 and got[2, 2][0] == 1.0


def test_contaminated_by_an_excerpt_of_a_long_item(spark):
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(400)]
    words[210] = "12"
    part = lambda n: " ".join(["other", "words", *words[200 : 200 + n], "go", "on"])
    rows = [part(60), part(13), part(12), part(60).replace("12", "31"), " ".join(x for i in range(0, 390, 30) for x in [*words[i : i + 9], "gap"])]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    bench = spark.createDataFrame([(7, " ".join(words))], "item_id long, text string")
    got = {r.doc_id: (r.n_windows, r.verbatim) for r in contaminated(docs, bench).collect()}
    assert got == {0: (53, True), 1: (6, True), 3: (53, False)}


def test_license_scan(spark):
    rows = [(1, "x y z Released under the MIT License. more"), (2, "All rights reserved"), (3, "the license of the work"), (4, None), (None, "word " * 50 + "licensed under cc by-nc 4.0")]
    got = {(r.doc_id, r.license) for r in license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, "MIT"), (2, "reserved"), (None, "CC-BY-NC-4.0")}


def test_license_scan_finds_every_template_anywhere(spark):
    rng = random.Random(6)
    filler = lambda: " ".join(f"w{rng.randrange(9_000)}" for _ in range(rng.randrange(1, 60)))
    rows = []
    for name, notice in TEMPLATES.items():
        for k in range(60):
            rows.append((len(rows), name, (f"{notice} {filler()}", f"{filler()} {notice.upper()} {filler()}", f"{filler()} {notice}", notice)[k % 4]))
    docs = spark.createDataFrame(rows, "doc_id long, name string, text string")
    found = {(r.doc_id, r.license) for r in license_scan(docs).collect()}
    missed = [(i, name) for i, name, _ in rows if (i, name) not in found]
    assert len(missed) <= len(rows) // 100, missed
    with pytest.raises(ValueError):
        license_scan(docs, {"short": "two words"})


def test_license_scan_on_a_whole_table(spark):
    """Every notice that stands word for word is found, and whatever is found has four fifths of the template's pairs."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    split = lambda t: [w for w in re.split(r"[^\w]+|_", (t or "").lower()) if w]
    found = {(r.doc_id, r.license): r.containment for r in license_scan(docs).collect()}
    want, pairs = set(), {}
    for r in docs.collect():
        words = split(r.text)
        whole = f" {' '.join(words)} "
        for name, notice in TEMPLATES.items():
            own = split(notice)
            pairs[r.doc_id, name] = len({*zip(own, own[1:])} & {*zip(words, words[1:])}) / len({*zip(own, own[1:])})
            if f" {' '.join(own)} " in whole:
                want.add((r.doc_id, name))
    assert want and want <= set(found) and all(share <= pairs[k] + 1e-9 and share >= 0.8 for k, share in found.items())


def test_license_scan_of_long_templates(spark):
    body = " ".join(f"word{i}" for i in range(300))
    rows = [(1, f"before {body} after"), (2, " ".join(body.split()[:200])), (3, "none of it")]
    got = license_scan(spark.createDataFrame(rows, "doc_id long, text string"), {"long": body, "short": "all rights reserved"}).collect()
    assert [(r.doc_id, r.license, r.containment > 0.99) for r in got] == [(1, "long", True)]


def test_shard_keeps_groups_of_equal_texts(spark):
    import zlib

    rows = [(i, f"text number {i} " + "x" * (i % 50)) for i in range(6_000)]
    size = sum(len(t) + 1 for _, t in rows)
    rows += [(10_000 + i, "seven tenths of a shard") for i in range(int(0.7 * size / 16 / 24))] + [(50_000 + i, "more than two shards of this") for i in range(int(2.5 * size / 16 / 29))]
    got = shard(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    total = sum(r.size for r in got)
    text = dict(rows)
    at, load = {}, Counter()
    for r in got:
        at.setdefault(text[r.doc_id], set()).add(r.shard)
        load[r.shard] += r.size
        assert r.size == len(text[r.doc_id]) + 1 and r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) and r.law == "bytes" and r.grown_shard is None
    assert {t for t, s in at.items() if len(s) > 1} == {"more than two shards of this"} and len(at["more than two shards of this"]) == 3
    assert max(load.values()) < 1.05 * total / 16 and min(load.values()) > 0.95 * total / 16
    for k in range(16):
        assert sorted(r.slot for r in got if r.shard == k) == list(range(sum(r.shard == k for r in got)))


def test_shard(spark, odd):
    many = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same text").otherwise(F.concat(F.lit("t"), "id")).alias("text"))
    got = shard(many).collect()
    size = Counter()
    for r in got:
        size[r.shard] += r.size
    assert sorted(size) == list(range(16)) and max(size.values()) < 1.1 * min(size.values())
    for k in range(16):
        assert sorted(r.slot for r in got if r.shard == k) == list(range(sum(r.shard == k for r in got)))
    assert shard(odd).count() == odd.count() and shard(odd.limit(0)).count() == 0


def test_contaminated_by_short_items(spark):
    items = ["Compute 12 + 7", "what is love", "Yes!", "?!", "the farmer sold five of her 3 brown cows to the man from the next village"]
    rows = [
        (1, "Compute 12 + 7"), (2, "So he said: \"What is love?\" and left."), (3, "First line.\nWHAT IS LOVE\nlast line"), (4, "what is love to him is not to me"),
        (5, "compute 12 + 8"), (6, "(yes)"), (7, "yes and no"), (8, "The farmer sold 6 of her four brown cows to the man from the next village"), (9, "the farmer sold five of her 3 brown cows to the man from the next village"), (10, None), (11, ""), (None, "yes"), (6, "(yes)")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame(list(enumerate(items)), "item long, text string")
    got = Counter((r.doc_id, r.item, r.verbatim) for r in contaminated(docs, bench, item_col="item").collect())
    assert got == Counter([(1, 0, True), (2, 1, True), (3, 1, True), (6, 2, True), (6, 2, True), (None, 2, True), (8, 4, False), (9, 4, True)])


def test_contaminated_with_other_names_and_units(spark):
    """Recall over the whole benchmark: every name (a capitalised word) and unit is replaced consistently."""
    bench = spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet").collect()
    rng = random.Random(9)
    new = []
    for r in bench:
        other = {}
        made = re.sub(r"\b[A-ZÄÖÜÉÈÊÀÇÑÁÍÓÚ][^\W\d_]*", lambda m: other.setdefault(m[0], "N" + "".join(rng.choices("bcdfg", k=9))), r.text)  # noqa: B023
        made = re.sub(r"(?<=\d )(km|kg|miles|hours|dollars|euros)\b", lambda m: {"km": "miles", "kg": "pounds", "miles": "km", "hours": "days", "dollars": "euros", "euros": "dollars"}[m[0]], made)
        new.append((r.item_id, made))
    bench = spark.createDataFrame(bench)
    got = {(r.doc_id, r.item_id) for r in contaminated(spark.createDataFrame(new, "doc_id long, text string"), bench).collect()}
    assert sum((i, i) in got for i, _ in new) >= 0.98 * len(new)


def test_many_long_pre_tokens_in_one_text(spark):
    rng = random.Random(10)
    text = " ".join("".join(rng.choices("abcdefghij", k=120)) for _ in range(20_000))
    start = time.time()
    path = public_tokenizers.path("piece_bpe_32k.model")
    got = token_counts(spark.createDataFrame([(1, text)], "doc_id long, text string"), path).first()
    assert got.n_tokens == len(sentencepiece.SentencePieceProcessor(model_file=path).encode(text)) and time.time() - start < 60


def test_shards_of_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(sharding, "LEAST_RANGES", 4)
    monkeypatch.setattr(sharding, "RANGE_BYTES", 150)
    rng = random.Random(11)
    rows = [(i, "x" * rng.randrange(200), f"p{i}") for i in range(1500)]
    assert sharding.n_ranges(sum(len(t) + 1 for _, t, _ in rows)) > 900
    got = shard(spark.createDataFrame(rows, "doc_id long, text string, p string"), shards=5, carry=("p", "text")).collect()
    assert sorted((r.doc_id, r.p, r.text) for r in got) == sorted((i, p, t) for i, t, p in rows)
    for k in range(5):
        assert sorted(r.slot for r in got if r.shard == k) == list(range(sum(r.shard == k for r in got)))
    loads = [sum(r.size for r in got if r.shard == k) for k in range(5)]
    assert max(loads) < 1.1 * min(loads)
    assert all(len({r.shard for r in got if r.text == t}) == 1 for _, t, _ in rows)


def test_quantiles_of_sketches_at_any_scale(spark, monkeypatch):
    """Quartiles of a measure over eight orders of magnitude, merged from groups, are off by the sketch's error at most."""
    rng = np.random.default_rng(12)
    x = np.concatenate([10 ** rng.uniform(-4, 4, 5000), np.zeros(50)])
    monkeypatch.setattr(quality, "MEASURES", {"m": (0.0, True)})
    df = spark.createDataFrame([(i % 7, float(v)) for i, v in enumerate(x)], "g int, m double")
    merged = quality.sketches(df, ["g"]).groupBy("measure", "bin").agg(F.sum("n").alias("n")).withColumn("one", F.lit(1))
    f = quality.fences(merged, ["one"]).first().fences["m"]
    q1, q3 = np.quantile(x, [0.25, 0.75], method="inverted_cdf")
    b_less_a = (f.high - f.low) / 7  # low is a - 3 (b - a), high b + 3 (b - a)
    a, b = f.low + 3 * b_less_a, f.high - 3 * b_less_a
    assert q1 / (1 + 2 * quality.ERROR) ** 2 <= a <= q1 * 1.0001 and q3 * 0.9999 <= b <= q3 * (1 + 2 * quality.ERROR) ** 2
    assert merged.count() < 1000


def test_suffixes_are_the_callers(spark):
    pages = spark.createDataFrame([(1, "https://a.b.zz.yy/x"), (2, "https://c.b.zz.yy/x"), (3, "https://d.zz.yy/x")], "page_id long, url string")
    labels = spark.createDataFrame([(i, 0, 1) for i in (1, 2)] * 3, "doc_id long, quality int, toxic int")
    means = lambda s: {r.page_id: round(r.good_bound, 9) for r in url_filter(pages, labels, (), suffixes=s).collect()}
    apart, joint = means(("zz.yy",)), means(())
    assert apart[1] == apart[2] and joint.keys() == apart.keys() and joint != apart
