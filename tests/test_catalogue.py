"""Every core query against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

from tidemark.plans import catalogue, cleaning  # noqa: F401

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for name in os.listdir(SF):
        c.execute(f"create view {name.split('.')[0]} as select * from '{SF}/{name}'")
    return c


def plain(x):
    return "~" if x is None else f"{x:.6g}" if isinstance(x, float) else str(x)


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_query(spark, db, name):
    df = catalogue.QUERIES[name](spark, SF)
    want = db.sql(catalogue.SQL[name])
    names = sorted(df.columns)
    assert names == sorted(want.columns)
    at = [want.columns.index(c) for c in names]
    assert sorted(tuple(map(plain, r)) for r in df.select(*names).collect()) == sorted(tuple(plain(r[i]) for i in at) for r in want.fetchall())
