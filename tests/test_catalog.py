"""Every registered query against its SQL twin on the smallest test tables."""

import os

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as contract  # noqa: E402
from harness.compare import rows_of  # noqa: E402
from harness.raw_tables import TABLES  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query_matches_oracle(spark, sql, name):
    df = contract.queries()[name](spark, SF_DIR)
    mine = rows_of(df.columns, df.collect())
    assert mine
    text = contract.oracle_sql().get(name)
    if text is None:
        return
    result = sql.execute(text)
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert mine == rows_of(columns, result.fetchall())


@pytest.mark.parametrize("name", ["q_fact_sales", "q_event_geo"])
def test_salted_joins_match_oracle(spark, sql, name, monkeypatch):
    """With hardly a threshold many customers, places, products and IPs are hot."""
    monkeypatch.setattr("clickloom.operators.joins.HOT_ROWS", 40)
    monkeypatch.setattr("clickloom.operators.joins.HOT_SHARE", 0.005)
    df = contract.queries()[name](spark, SF_DIR)
    result = sql.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert rows_of(df.columns, df.collect()) == rows_of(columns, result.fetchall())


def test_entry(spark):
    assert contract.entry(spark).limit(1).count() == 1
