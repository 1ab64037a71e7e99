"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from docketflow import catalogue

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


def cell(x):
    if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and x != x):
        return None
    if isinstance(x, float):
        return str(int(x)) if x == int(x) and abs(x) < 1e15 else repr(round(x, 9))
    return str(x)


def normal(df):
    df = df[sorted(df.columns)]
    return sorted((tuple(map(cell, r)) for r in df.astype(object).itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query_matches_sql(spark, con, name):
    got = catalogue.queries()[name](spark, SF).toPandas()
    sql = catalogue.oracle_sql().get(name)
    if sql is None:
        assert len(got) > 0
        return
    want = con.sql(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert normal(got) == normal(want)


def test_entry(spark):
    import __spark_entry__ as entry

    got = entry.entry(spark)
    assert got.columns == ["host", "attempts", "answered", "unanswered", "error_rate_pct", "last_ok_at", "label"]
    assert {"degraded", "delivering"} <= {r.label for r in got.collect()}
    assert set(entry.oracle_sql()) <= set(entry.queries())
