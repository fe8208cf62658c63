"""Unit vectors of the string, presence and null functions."""

import itertools

import pytest
from pyspark.sql import functions as F

from tidemark.functions import nulls, presence, text


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(("code", "want"), [("01234", ["01234", "12340"]), ("01230", ["01230", "00123", "12300"]), ("01200", ["01200", "00012", "00120", "12000"]), ("", []), (None, []), ("00000", ["00000"])])
def test_zip_candidates(spark, code, want):
    got = one(spark, text.zip_candidates(F.lit(code).cast("string")))
    assert got[:1] == want[:1] and sorted(got) == sorted(want)


@pytest.mark.parametrize(("code", "want"), [("2139", "02139"), ("213", "02130"), ("7", "00000"), ("02139", "02139")])
def test_pad_zip(spark, code, want):
    assert one(spark, text.pad_zip(F.lit(code))) == want


def test_address(spark):
    assert one(spark, text.normalise_address(F.lit(" 12  Main St. ,Apt#4 "))) == "12 main st, apt4"
    assert [one(spark, text.is_mailbox(F.lit(x))) for x in ("P O BOX 3", "po box 3", "POBOX 3")] == [True, True, False]
    assert [one(spark, text.acronym_or_city(F.lit(x), F.lit(False))) for x in ("ST", "U.S.A.", "NYC")] == ["Unknown", "Acronym", "Acronym"]


@pytest.mark.parametrize(("bits", "want"), [("101", "111"), ("10001", "11111"), ("100001", "100001"), ("10101", "11111")])
def test_fill_gaps(spark, bits, want):
    assert one(spark, presence.fill_gaps(F.lit(bits))) == want


@pytest.mark.parametrize(("bits", "want"), [("110", "111"), ("1000", "1111"), ("10000", "10000")])
def test_fill_end(spark, bits, want):
    assert one(spark, presence.fill_end(F.lit(bits))) == want


def test_fill_gaps_on_all_strings(spark):
    """Against filling step by step until nothing changes."""
    every = ["".join(x) for x in itertools.product("01", repeat=11)]

    def fixed(s):
        while True:
            t = s
            for n in (1, 2, 3):
                t = t.replace("1" + "0" * n + "1", "1" * (n + 2))
            if t == s:
                return s
            s = t

    got = {r.s: r.f for r in spark.createDataFrame([(s,) for s in every], "s string").select("s", presence.fill_gaps(F.col("s")).alias("f")).collect()}
    assert got == {s: fixed(s) for s in every}


def test_persistence_and_reference(spark):
    assert one(spark, presence.persistence(F.lit("11111"), F.lit("1" * 21))) == pytest.approx(4.2)
    assert one(spark, presence.persistence(F.lit("11111"), F.lit("0" * 21))) == 0
    assert one(spark, presence.reference(F.lit(2005), F.lit(2012), False)) == "2010 Census"
    assert one(spark, presence.reference(F.lit(2005), F.lit(2012), True)) == "2000 Census"
    assert one(spark, presence.closures(F.lit("00000100000"))) == 1


def test_null_rules(spark):
    df = spark.createDataFrame([(1, 1.0), (1, None), (2, 3.0)], "k int, x double")
    got = {r.k: r.m for r in df.groupBy("k").agg(nulls.strict_max(F.col("x")).alias("m")).collect()}
    assert got == {1: None, 2: 3.0}
    assert df.filter(nulls.not_in(F.col("x"), [3.0])).count() == 2
