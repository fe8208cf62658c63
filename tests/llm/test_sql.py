"""Queries with SQL against it, over a whole small table."""

from collections import Counter

import __spark_entry__
import duckdb
import pytest
from tidemark.llm.queries import SQL


@pytest.mark.parametrize("name", SQL)
@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_equals_sql(spark, name, sf):
    con = duckdb.connect()
    for table in ("documents", "pages", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '/root/testdata/sf{sf}/{table}.parquet'")
    got = __spark_entry__.queries()[name](spark, f"/root/testdata/sf{sf}")
    columns = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({SQL[name]})").fetchall()
    assert Counter(map(tuple, got.select(*columns).collect())) == Counter(want)
    assert want
