"""Every registered query against its SQL oracle (DuckDB), order-insensitive, at sf0.001."""

import os

import duckdb
import pytest

import __spark_entry__ as se
from conftest import SF_SMOKE
from martflow.plans.registry import ORACLE, QUERIES
from tools.check_oracle import TABLES, canon


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF_SMOKE, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "order_id"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF_SMOKE)
    sc, sr = canon(sdf.columns, [tuple(r) for r in sdf.collect()])
    res = duck.execute(ORACLE[name])
    dc, dr = canon([d[0] for d in res.description], res.fetchall())
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr
