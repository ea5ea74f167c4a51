"""The registered queries of this subpackage that have SQL, against DuckDB."""

import os

import duckdb
import pytest

from tests.conftest import SF_SMALL
from ticklake.llm.queries import all_queries, all_sql

TABLES = ["documents", "pages", "benchmark", "labels", "conversations"]


@pytest.mark.parametrize("name", sorted(all_sql()))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t + '.parquet')}')")
    got = all_queries()[name](spark, SF_SMALL)
    res = con.execute(all_sql()[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == sorted(got.columns)
    rows = sorted((tuple(r[c] for c in names) for r in got.collect()), key=repr)
    assert rows == sorted((tuple(x.replace(tzinfo=None) if hasattr(x, "tzinfo") else x for x in r) for r in res.fetchall()), key=repr)
