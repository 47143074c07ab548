"""Driver contract: entry runs, every query has a known oracle status, and results agree with
DuckDB on the smallest tables."""

import os
import sys

import duckdb
import pytest

from conftest import SF_SMALL

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as E  # noqa: E402
from mutualis.plans import ORACLES, QUERIES  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["businessid", "address", "categories", "avg_stars"]
    assert 0 < df.count() <= 10


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    def v(x):
        if isinstance(x, float):
            return round(x, 9)
        return x
    return sorted((tuple(v(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    res = con.execute(ORACLES[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _norm([tuple(r) for r in df.collect()], df.columns) == _norm(res.fetchall(), dcols)
