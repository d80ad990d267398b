"""The driver contract: every registered query equals its DuckDB twin (sf0.001)."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "scripts"))

import __spark_entry__ as entry  # noqa: E402
from measures.plans import catalog, oracle  # noqa: E402
from oracle_check import TABLES, rows_key  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    if not os.path.exists(f"{SF}/events.parquet"):
        pytest.skip("driver tables not present")
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{SF}/{t}.parquet"):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_smoke(spark, duck):
    df = entry.entry(spark)
    assert df.count() > 0 and "measurement_count" in df.columns


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(oracle.ORACLES)
    assert set(catalog.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    rel = duck.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    s_rows = [tuple(r) for r in df.collect()]
    d_rows = rel.fetchall()
    assert len(s_rows) == len(d_rows)
    assert rows_key(s_rows, df.columns) == rows_key(d_rows, rel.columns)
