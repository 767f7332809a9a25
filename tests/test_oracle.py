"""Every registered query of the core equals its DuckDB oracle on the sf0.001 driver tables."""

import duckdb
import pytest

import __spark_entry__ as E
from check_oracle import TABLES, digest
from txnwatch.plans.catalog import QUERIES
from txnwatch.plans.oracle import ORACLE

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    got = digest(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(ORACLE[name])
    want = digest([d[0] for d in cur.description], cur.fetchall())
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["event_dt", "passport", "fio", "phone", "event_type", "report_dt"]
    assert df.count() > 0
