"""Every registered query against its DuckDB oracle (row count, columns, values)."""

import datetime as dt
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from ticklake.plans.catalog import all_queries
from ticklake.plans.oracle import all_sql

TABLES = ["events"]
QUERIES, SQL = all_queries(), all_sql()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _key(row):
    return tuple((x is None, type(x).__name__, x if x is not None else 0) for x in row)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t + '.parquet')}')")
    return con


def test_every_query_has_an_oracle_or_is_documented():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["product_id", "cumulative_volume", "vwap"]
    assert df.count() >= 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols = df.columns
    got = sorted([tuple(_norm(r[c]) for c in cols) for r in df.collect()], key=_key)
    res = duck.execute(SQL[name])
    ocols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(ocols)
    idx = [ocols.index(c) for c in cols]
    exp = sorted([tuple(_norm(r[i]) for i in idx) for r in res.fetchall()], key=_key)
    assert got == exp
