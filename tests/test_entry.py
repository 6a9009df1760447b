"""Driver contract and oracle agreement on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from stratum.plans.queries import REGISTRY

SF = "/root/testdata/sf0.001"
VIEWS = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "total_revenue" in df.columns


def test_registry_shape():
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 60
    assert set(REGISTRY) <= set(sql)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for v in VIEWS:
        c.execute(f"CREATE VIEW {v} AS SELECT * FROM read_parquet('{SF}/{v}.parquet')")
    return c


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    res = con.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    s = _norm([tuple(r) for r in df.collect()], df.columns)
    d = _norm(res.fetchall(), dcols)
    assert s == d
