"""The corpus pipeline on a whole small table, each stage against a plain statement of what it may keep."""

from collections import Counter
from itertools import combinations

import corpus_pipeline
from test_pairs import components, sets_of

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = corpus_pipeline.read(spark, SF, "documents")
    columns, kept = docs.columns, {}
    for name, step in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage(step(spark, docs, SF), name)
        kept[name] = docs.collect()
        if name != "sharding":
            assert docs.columns == columns
    toxic, near, clean, mixed, shards = kept.values()
    sets = sets_of(toxic)
    links = [(a, b) for a, b in combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    root = components(sets, links)
    assert links
    assert sorted(r.doc_id for r in near) == sorted(i for i in root if root[i] == i)
    assert {r.doc_id for r in clean} <= {r.doc_id for r in near}
    times = Counter(r.doc_id for r in mixed)
    assert set(times) <= {r.doc_id for r in clean} and max(times.values()) <= 2
    assert Counter(r.doc_id for r in shards) == times
    text = {r.doc_id: r.text for r in mixed}
    assert all(r.text == text[r.doc_id] and r.size == len((r.text or "").encode()) + 1 for r in shards)
    for s in {r.shard for r in shards}:
        assert 0 <= s < 16
        assert sorted(r.slot for r in shards if r.shard == s) == list(range(sum(r.shard == s for r in shards)))
    again = corpus_pipeline.run(spark, SF)
    assert Counter(map(tuple, again.select("doc_id", "size", "text_crc32").collect())) == Counter((r.doc_id, r.size, r.text_crc32) for r in shards)


def test_two_texts_under_one_id(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(3, a), (5, a + " end"), (5, b), (7, b + " end"), (8, c), (8, c + " end"), (8, c), (9, None), (9, None), (None, a), (10, b + " last")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter(map(tuple, corpus_pipeline.drop_near_copies(spark, docs, SF).collect()))
    eight = [r for r in got if r[0] == 8]
    assert len(eight) == 1 and got == Counter([(3, a), (5, b), (9, None), (None, a), *eight])
