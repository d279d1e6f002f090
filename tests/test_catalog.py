"""Every registered query of the engine against its SQL on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from skarn import catalog

DIR = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{DIR}/*.parquet"):
        con.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_matches_sql(spark, duck, name):
    got = catalog.queries()[name](spark, DIR)
    want = duck.sql(catalog.oracle_sql()[name])
    columns = sorted(got.columns)
    assert sorted(want.columns) == columns
    a = [tuple(plain(r[c]) for c in columns) for r in got.collect()]
    at = [want.columns.index(c) for c in columns]
    b = [tuple(plain(r[i]) for i in at) for r in want.fetchall()]
    assert sorted(a, key=str) == sorted(b, key=str)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns
    assert set(catalog.queries()) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())
