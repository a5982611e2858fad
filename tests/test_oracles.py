"""Every registered query equals its DuckDB statement (sf0.001, row-exact,
order-insensitive, columns compared by name) -- the correctness gate, in pytest."""

import math
from datetime import datetime

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def table(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(set(E.QUERIES)))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    got_cols, got = table(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(E.oracle_sql()[name])
    want_cols, want = table([d[0] for d in res.description], res.fetchall())
    assert got_cols == want_cols
    assert got == want
