"""Driver contract: entry() runs; every oracle-backed query equals DuckDB at sf0.001."""

import datetime as dt
import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF0001
from triplake.catalog import QUERIES, oracle_sql
from triplake.sources.fixture import TABLES


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["split", "rows", "label_rate", "first_trip", "last_trip"]
    assert sum(r.rows for r in rows) == 2521


def test_every_library_query_has_an_oracle():
    assert set(QUERIES) == set(oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF0001)
    s_cols = df.columns
    s_rows = Counter(tuple(_norm(x) for x in r) for r in df.collect())
    rel = con.execute(entry.oracle_sql()[name])
    d_cols = [d[0] for d in rel.description]
    assert sorted(s_cols) == sorted(d_cols)
    idx = [d_cols.index(c) for c in s_cols]
    d_rows = Counter(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())
    assert s_rows == d_rows
