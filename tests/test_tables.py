"""Sources and sinks, clusters of raw values, and the survivor ladder on small tables."""

import gzip
import math
import random
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.functions import presence, text
from tidemark.functions.similarity import jaro
from tidemark.operators import cities, clusters, consolidate, merged, nearest, places, survivors
from tidemark.sources import ranges, tables, typed


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a, b", None), (2, None, 0.5), (3, "NAN", 1.5)], "id int, name string, x double")
    tables.write_csv(df, f"{tmp_path}/by", ["id"], "gzip")
    back = tables.read_csv(spark, f"{tmp_path}/by", "name string, x double").drop("id")
    assert sorted(map(str, back.collect())) == sorted(map(str, df.drop("id").collect()))
    with gzip.open(tmp_path / "numbered.csv.gz", "wt") as f:
        f.write('"","id","name"\n"1",7,NA\n"2",8,"x"\n')
    (tmp_path / "plain.csv").write_text('"","id","name"\n"1",9,"y"\n')
    got = tables.read_csv(spark, [f"{tmp_path}/numbered.csv.gz", f"{tmp_path}/plain.csv"], "id int, name string", with_file=True, numbered=True)
    assert sorted(map(tuple, got.collect()), key=str) == [(7, None, "numbered.csv.gz"), (8, "x", "numbered.csv.gz"), (9, "y", "plain.csv")]


def test_row_numbers_and_ranges(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("v"))
    got = tables.with_row_numbers(df, ["v"]).collect()
    assert len(got) == 1000 and all(r.rowname == r.v + 1 for r in got)
    own = df.withColumns({"_part": F.lit("p"), "id": F.lit("i")})
    assert tables.with_row_numbers(own, ["v"], "n").select("_part", "id", "n").distinct().count() == 1000  # the user's columns stay


def test_ranges_resume(spark, tmp_path):
    path = f"{tmp_path}/first"
    folders = lambda: sorted(p.name for p in Path(path).iterdir() if "=" in p.name)
    ledger = lambda: {r.first: (r.state, r.n_rows) for r in ranges.range_ledger(spark, path).collect()}
    back = lambda: sorted(r.n for r in ranges.read_ranges(spark, path, "n long, v string").collect())
    df = spark.range(1, 1001).select(F.col("id").alias("n"), F.concat(F.lit("v"), "id").alias("v"))
    assert ranges.range_ledger(spark, path).count() == 0
    assert ranges.write_ranges(df.filter("n <= 400"), path, "n", 400) == 1
    assert ranges.write_ranges(df.filter("n between 401 and 800"), path, "n", 400) == 1
    assert folders() == ["rows=1 to 400", "rows=401 to 800"] and back() == list(range(1, 801))
    with pytest.raises(ValueError, match="another size"):
        ranges.write_ranges(df, path, "n", 50)
    path = f"{tmp_path}/out"
    # a run that dies in its second job: its ranges are begun, not finished, and the next run takes up there

    @F.udf("string")
    def dies(n, v):
        if n == 950:
            raise RuntimeError("lost")
        return v

    with pytest.raises(Exception, match="lost"):
        ranges.write_ranges(df.select("n", dies("n", "v").alias("v")), path, "n", 50, at_once=2)
    state = ledger()
    assert state[851] == ("finished", 50) and state[901] == ("begun", None) and state[951] == ("begun", None) and state[401] == ("finished", 50)
    assert ranges.write_ranges(df, path, "n", 50, at_once=2) == 2
    assert all(v == ("finished", 50) for k, v in ledger().items() if k > 800)
    # a repeated range replaces itself alone, even by fewer rows or none
    assert ranges.write_ranges(df, path, "n", 50) == 0
    assert ranges.write_ranges(df.filter("n > 20"), path, "n", 50, only=[7, 50, 51], again=True) == 2
    assert ledger()[1] == ("finished", 30) and ledger()[51] == ("finished", 50)
    assert ranges.write_ranges(df.filter("n > 50"), path, "n", 50, only=[1], again=True) == 1
    assert ledger()[1] == ("finished", 0) and "rows=1 to 50" not in folders()
    with pytest.raises(ValueError, match="no number"):
        ranges.write_ranges(df.withColumn("n", F.nullif("n", F.lit(3))), path, "n", 50)
    assert ranges.write_ranges(df.limit(0), path, "n", 50) == 0


def test_no_row_of_a_null_key_is_lost(spark):
    rows = [(None, "12 Main St", 1.0, 1), (None, "12 main st", 900.0, 1), (None, "Oak", 1.0, 1), ("k", "12 Main St", 1.0, 1), ("k", "12 Main St.", 2.0, None), ("one", "Elm", 3.0, 1)]
    df = spark.createDataFrame(rows, "k string, v string, x double, f int")
    done = consolidate.consolidated(df, "k", "v", "x", {"f": F.col("f")}, 0.15, 100.0).collect()
    assert sorted((str(r.k), r.cluster, r.n_rows, r.status) for r in done) == [("None", "12 Main St", 1, "Expanded"), ("None", "12 main st", 1, "Expanded"), ("None", "Oak", 1, "TRUE"), ("k", "12 Main St", 2, "TRUE"), ("one", "Elm", 1, None)]
    assert consolidate.reductions(df, consolidate.without_missing(spark.createDataFrame(done), "k", "cluster"), "k", "cluster").first().new_keys == 0


GAZETTEER = [("ROSEWOOD", "PA", "19001"), ("ROSEWEED", "PA", "19001"), ("BOULDER", "CO", "80301")]


def test_matched_cities(spark):
    rows = [("ROSEWOOD", "MA", "1"), ("ROSWOOD", "PA", "19001"), ("Rosewod.", "PA", "19001"), ("ROSWOOD", "PA", "19002"), ("ROSWOOD", None, "19001"), (None, "PA", "19001"), ("XYZ", "PA", "19001"), ("", "PA", "19001")]
    df = spark.createDataFrame(rows * 3, "c string, s string, z string")
    gazetteer = spark.createDataFrame([*GAZETTEER, GAZETTEER[0], (None, "PA", "19001")], "city string, state_id string, zip string")
    got = {(r.city, r.state, r.zip): (r.is_city, r.place) for r in cities.matched_cities(df, F.col("c"), F.col("s"), F.col("z"), gazetteer, 0.15).collect()}
    assert got == {rows[0]: (True, None), rows[1]: (False, "ROSEWOOD"), rows[2]: (False, "ROSEWOOD"), **{r: (False, None) for r in rows[3:]}}
    assert cities.matched_cities(df, F.col("c"), F.col("s"), F.col("z"), gazetteer.limit(0), 0.15).filter("is_city or place is not null").isEmpty()


def test_borrowing_and_null_keys(spark):
    none, ok = survivors.NO_MATCH, "ok"
    rows = [(7, 0, 0.0, none, "1 A", 1, 0), (7, 1, 0.1, none, "2 B", 1, 0), (7, 2, 0.5, ok, "PO BOX 3", 0, 1), (7, 3, 0.9, ok, "5 C", 0, 0), (7, 4, 9.0, ok, "6 D", 0, 0),
            (None, 5, 0.0, ok, "1 A", 1, 0), (None, 6, 0.0, none, "1 A", 1, 0), (8, 9, 0.0, none, "1 A", 1, 0), (8, 10, 0.0, none, "1 AB", 1, 0)]
    df = spark.createDataFrame([(*r, "p", "q") for r in rows], "k int, r int, x double, answer string, address string, f int, g int, _len string, kept string")
    gazetteer = spark.createDataFrame(GAZETTEER, "city string, state_id string, zip string")
    df = df.withColumns({"city": F.lit("C"), "state": F.lit("PA"), "zip": F.lit("1")})
    flags = {"f": F.col("f"), "g": F.col("g")}
    got = survivors.select_survivors(df, "k", "r", flags, F.col("x"), F.lit(0.0), 1.0, F.col("answer"), F.col("address"), line=F.col("address"), extra=F.lit(None).cast("string"), city="city", state="state", zip_="zip", gazetteer=gazetteer, threshold=0.15)
    by = {r.r: r for r in got.collect()}
    assert len(by) == len(rows) and by[5]._len == "p" and by[5].kept == "q"
    assert {i: r.decision for i, r in by.items()} == {0: "Drop", 1: "Drop", 2: "Keep", 3: "Keep", 4: "Keep", 5: "Keep", 6: "Drop", 9: "Drop", 10: "Keep"}
    assert [i for i, r in by.items() if r.lender is not None] == [0] and by[0].lender == 3  # 2 is nearer, but a mailbox
    assert by[0].cluster == 0 and by[0].is_noise is False and by[4].is_noise is None and by[10].needs_review
    packed = {r.r: (r.f, r.g) for r in survivors.compressed(got, "k", "r", {"f": "f", "g": "g"}).collect()}
    assert packed[3] == (1, 0) and packed[2] == (0, 1) and packed[5] == (1, 0)
    checks = {(r.k, r.cluster): (r.consistent, r.one_kept) for r in survivors.survivor_checks(survivors.compressed(got, "k", "r", {"f": "f", "g": "g"}), "k", "r", ["f", "g"]).collect()}
    assert checks == {(7, 0): (True, True), (None, 5): (True, True), (8, 9): (True, True)}


def test_nearest_offers(spark, monkeypatch):
    monkeypatch.setattr(nearest, "LEAF", 4)
    rng = random.Random(6)
    crowd = [(0, i, rng.choice([3.0, rng.random() * 1e-3]), 0.0, i % 4 == 0) for i in range(2000)]  # a hot place and a crowded line
    wide = [(rng.choice([0, 1, None]), 2000 + i, rng.uniform(-50, 50), rng.uniform(-5, 5), i % 3 == 0) for i in range(1500)]
    odd = [(1, 9000, None, 1.0, True), (1, 9001, 1.0, None, False), (5, 9002, 1.0, 1.0, True), (6, 9003, 1.0, 1.0, False), (6, 9004, 4.0, 5.0, True)]
    rows = crowd + wide + odd
    df = spark.createDataFrame(rows, "g int, r int, x double, y double, asks boolean")
    for reach in (float("inf"), 2.0):
        got = nearest.nearest_offers(df.filter("asks"), df.filter("not asks"), "g", "r", F.col("x"), F.col("y"), reach).collect()
        assert len(got) == sum(r[4] for r in rows)
        offers = {}
        for g, r, x, y, asks in rows:
            if not asks and x is not None and y is not None:
                offers.setdefault(g, []).append((x, y, r))
        at = {r: (g, x, y) for g, r, x, y, _ in rows}
        for r in got:
            g, x, y = at[r.r]
            best = min(((math.hypot(x - u, y - v), o) for u, v, o in offers.get(g, [])), default=None) if x is not None else None
            if best is None or best[0] > reach:
                assert r.offer is None and r.distance is None
            else:
                assert abs(r.distance - best[0]) < 1e-12 and math.hypot(x - at[r.offer][1], y - at[r.offer][2]) == pytest.approx(best[0], abs=1e-12)


def test_align(spark):
    a, b = spark.createDataFrame([(1, "x")], "k int, other string"), spark.createDataFrame([], "k long, `2001` int")
    out = tables.align(a, b)
    assert out.dtypes == [("k", "bigint"), ("2001", "int")] and out.first()[0] == 1 and tables.year_columns(b) == ["2001"]


def test_clusters_compare_normalised_values(spark):
    rows = [("b", "12 MAIN STREET"), ("b", "12 main street"), ("b", "12 Main  Street."), ("b", "77 Oak"), ("b", None), (None, "x y"), (None, "X Y")]
    df = spark.createDataFrame(rows, "b string, v string")  # a block named b
    got = {(r.b, r.v): r.cluster for r in clusters.clusters(df, "b", "v", 0.15).collect()}
    assert {v for k, v in got.items() if k[1].lower().startswith("12")} == {"12 MAIN STREET"} and got["b", "77 Oak"] == "77 Oak" and got[None, "x y"] == "X Y"
    exact = {(r.b, r.v): r.cluster for r in clusters.clusters(df, "b", "v", 0).collect()}
    assert len(exact) == 6 and all(k[1] == v for k, v in exact.items())


def test_large_blocks_in_tiles(spark, monkeypatch):
    df = spark.range(120).select(F.lit("k").alias("k"), F.concat(F.lit("street number "), F.col("id") * 37).alias("v"))
    want = sorted(map(tuple, clusters.similar_pairs(df, "k", F.col("v"), 0.1).collect()))
    monkeypatch.setattr(clusters, "TILE", 25)
    assert sorted(map(tuple, clusters.similar_pairs(df, "k", F.col("v"), 0.1).collect())) == want and len(want) > 100


def test_jaro_in_batches():
    a, b = ["MARTHA", "DIXON", "", "a", "abc" * 30, "same"], ["MARHTA", "DICKSONX", "a", "", "acb" * 30, "same"]
    got = jaro(a, b)
    assert [round(x, 4) for x in got[:4]] == [0.9444, 0.7667, 0, 0] and got[5] == 1 and all(jaro([x], [y])[0] == z for x, y, z in zip(a, b, got, strict=True))


def ladder(spark, rows):
    df = spark.createDataFrame(rows, "r int, answer string, line string, extra string, city string").withColumns({"k": F.lit(1), "state": F.lit("PA"), "zip": F.lit("19001")})
    gazetteer = spark.createDataFrame(GAZETTEER, "city string, state_id string, zip string")
    out = survivors.survivor_ladder(df, ["k"], "r", F.col("answer"), F.col("line"), F.col("extra"), "city", "state", "zip", gazetteer, 0.15)
    return [(r.r, r.by_city, r.needs_review, r.city) for r in out.filter("decision = 'Keep'").collect()]


def test_ladder(spark):
    long, none, city = "x" * 47, survivors.NO_MATCH, "BOULDER"
    assert ladder(spark, [(1, "ok", "9 A", None, city), (2, "ok", long, None, "a")]) == [(2, False, False, "a")]  # no digit near the longest
    assert ladder(spark, [(1, "ok", "9" + "y" * 44, None, city), (2, "ok", long, None, "a")]) == [(1, False, False, city)]  # 45 and 47 are alike
    assert ladder(spark, [(1, "ok", "9" + "y" * 46, None, "a"), (2, "ok", long, None, city)]) == [(1, False, False, "a")]
    assert ladder(spark, [(1, none, "12 long street", "apt", city), (2, "ok", "1 st", None, "a")]) == [(2, False, False, "a")]
    assert ladder(spark, [(1, none, "1 st", None, city), (2, none, "1 st", "apt", "a")]) == [(2, False, True, "a")]
    assert ladder(spark, [(1, "ok", "1 st", None, "a"), (2, "ok", "2 st", None, "ROSWEOD"), (3, "ok", None, None, city)]) == [(2, True, False, "ROSEWOOD")]
    assert ladder(spark, [(1, "ok", "1 st", None, "ROSWEOD"), (2, "ok", "2 st", None, "ROSEWOO"), (3, "ok", "3 st", None, None)]) == [(2, True, False, "ROSEWOOD")]  # the most similar one
    assert ladder(spark, [(2, "ok", "1 st", None, "a"), (1, "ok", "2 st", None, None)]) == [(1, False, False, None)]


def test_density_clusters(spark):
    rows = [(1, 0, 0.0, 0.0), (1, 2, 0.0, 0.0), (1, 3, 0.9, 0.0), (1, 4, 5.0, 5.0), (1, 5, 1.9, 0.0), (2, 6, None, 1.0), (2, 7, 3.0, 3.0), (3, 8, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "g int, p int, x double, y double")
    got = {r.p: (r.cluster, r.is_noise, r.problem_geo) for r in places.density_clusters(df, "g", "p", F.col("x"), F.col("y"), 1.0).collect()}
    one, alone, lacking = (0, False, False), (None, True, False), (6, False, True)
    assert got == {0: one, 2: one, 3: one, 5: one, 4: alone, 6: lacking, 7: lacking, 8: alone}


def test_presence_and_parts(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert [one(presence.fill_start(F.lit(x))) for x in ("1000001", "100", "0100001", "101")] == ["1111101", "110", "0111101", "101"]
    assert [one(presence.looks_ahead(F.lit(a), F.lit(b))) for a, b in (("0001", "0"), ("0100", "01"), ("0100", "00"), ("0000", "11"))] == [True, True, False, False]
    assert one(presence.reopenings(F.lit("10000110000"))) == 1
    assert one(text.geocoder_parts(F.lit("1 A St, Apt 2, Town, MA 01301"))).asDict() == {"street": "1 A St, Apt 2", "city": "Town", "state": "MA", "zip": "01301"}
    assert one(text.geocoder_parts(F.lit("1 A St, Town"))) is None and one(text.geocoder_parts(F.lit("1 A St, Town, MA"))) is None and one(text.address_parts(F.lit("a, b, c"))) is None
    assert one(text.parse_address(F.lit("77 BROADWAY, CHELSEA, MA 02150-2607"))).asDict() == {"line_1": "77 BROADWAY", "line_2": None, "city": "CHELSEA", "state": "MA", "zip": "02150-2607"}


AT = merged.Columns(key="k", line="a", city="c", state="s", zip="z", longitude="x", latitude="y", code="n", established="e", order="i", prefix="9")


def raw_records(spark):
    rows = [
        (1, "12 Main St", 0.0, 0.0, "901", 1990, 1), (1, "12 main st", 0.0, 0.1, "902", None, 1), (1, "Oak", None, 0.0, "901", 1980, None),
        (2, "5 Elm", 0.0, 0.0, "9", None, 1), (2, "5 Elm", 9.0, 0.0, "9", None, 1),  # the same address at two places
        (3, "7 Long Road", 0.0, 0.0, "901", None, 1), (3, "7 Long Roads", 9.0, 0.0, "901", None, 1), (3, "7 Long Road", 0.0, 0.0, "901", None, 1),
        (4, "Lone", 1.0, 1.0, "903", 2001, 1), (5, None, 1.0, 1.0, "903", 2001, 1), (6, "x", 1.0, 1.0, "903", 2001, 1), (6, None, 1.0, 1.0, "903", 2001, 1), (None, "Nil", 1.0, 2.0, "904", 2001, 1), (None, "nil", 1.0, 2.0, "904", 2001, 1)]
    return spark.createDataFrame([(*r, i, "C", "S", "01") for i, r in enumerate(rows)], "k int, a string, x double, y double, n string, e int, f int, i int, c string, s string, z string")


def test_merged_table(spark):
    table, checks = merged.merged(raw_records(spark), AT, {"f": F.col("f")}, 0.15, 0.5)
    got = {(r.k, r.compiled_address): (r.status, r.lonlat_test, r.same_num_clusters, r.n_rows, r.f) for r in table.collect()}
    assert got == {
        (1, "12 Main St, C, S, 01"): ("TRUE", True, None, 2, 2), (1, "Oak, C, S, 01"): (None, None, None, 1, 0), (2, "5 Elm, C, S, 01"): ("Overridden", False, True, 2, 2),
        (3, "7 Long Road, C, S, 01"): ("Expanded", True, False, 2, 2), (3, "7 Long Roads, C, S, 01"): ("Expanded", None, False, 1, 1), (4, "Lone, C, S, 01"): (None, None, None, 1, 1), (None, "Nil, C, S, 01"): ("TRUE", True, None, 2, 2)}
    one = table.filter("k = 1 and status is not null").first()
    assert (one.year_established, one.extra_code, one.code, one.latitude, one.address_line_1) == ("1980, 1990", "01, 02", "9", 0.05, "12 Main St")
    assert table.filter("k = 3").first().year_established == "None listed"
    c = checks.first()
    assert c.a and c.b and c.c and c.d and c.e and (c.rows_before, c.rows_after, c.keys_before) == (14, 7, 7)


def test_merged_invariants_fail_when_keys_are_lost(spark, monkeypatch):
    real = merged.clusters
    monkeypatch.setattr(merged, "clusters", lambda *a: real(*a).filter("k <> 2 or k is null"))
    c = merged.merged(raw_records(spark), AT, {"f": F.col("f")}, 0.15, 0.5)[1].first()
    assert not (c.a or c.b or c.c or c.d or c.e)
    monkeypatch.setattr(merged, "clusters", lambda *a: real(*a).withColumn("k", F.when(F.col("k") == 6, None).otherwise(F.col("k"))))
    c = merged.merged(raw_records(spark), AT, {"f": F.col("f")}, 0.15, 0.5)[1].first()
    assert not (c.a or c.c) and c.d and c.e  # a key without an address was lost: the final table is right


def test_types_and_rejects(spark):
    rows = [(1, "01234", "7", "1.5", "2001-01-01", "true", None, "+3"), (2, "12345", " 8 ", "2", "NA", "FALSE", "", "-4"), (3, "99999", "x", "1e3", "2001-13-01", "yes", "NA", "5"), (4, "0", None, ".5", "2001-12-31", "", None, "99999999999999999999")]
    names = ["zip", "whole", "number", "day", "truth", "none", "big"]
    df = spark.createDataFrame([(*r, "x") for r in rows], f"r int, {', '.join(f'{n} string' for n in names)}, bad string")
    strict = typed.inferred(df, names)
    assert strict == {"zip": "string", "whole": "string", "number": "double", "day": "string", "truth": "string", "none": "string", "big": "double"}
    loose = typed.inferred(df, names, 0.4)
    assert loose == {**strict, "whole": "long", "day": "date", "truth": "boolean", "big": "long"}
    good, rejects = typed.typed(df, loose, "r")
    assert {(r.row, r.column, r.value) for r in rejects.collect()} == {(3, "whole", "x"), (3, "day", "2001-13-01"), (3, "truth", "yes"), (4, "big", "99999999999999999999")}
    assert {r.reason for r in rejects.filter("column = 'big'").collect()} == {"number in a column of type long"}
    assert [tuple(r)[:8] for r in good.orderBy("r").collect()] == [(1, "01234", 7, 1.5, date(2001, 1, 1), True, None, 3), (2, "12345", 8, 2.0, None, False, None, -4)]
    assert typed.inferred(df.limit(0), names) == dict.fromkeys(names, "string") and typed.typed(df.limit(0), loose, "r")[0].count() == 0
