"""Every registered query against its DuckDB oracle on the smoke tables
(the driver runs the same comparison at sf0.01)."""

import pytest

import __spark_entry__ as E
from instalytics import catalog
from instalytics.oracle.compare import compare, duckdb_conn

SMOKE = "/root/testdata/sf0.001"

QUERIES = catalog.queries()
NAMES = list(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duckdb_conn(SMOKE)


@pytest.fixture(scope="module")
def oracle():
    return catalog.oracle_sql()


def test_every_query_has_oracle(oracle):
    assert set(NAMES) == set(oracle)
    assert len(NAMES) == 60
    assert set(NAMES) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, con, oracle, name):
    r = compare(QUERIES[name](spark, SMOKE), con, oracle[name])
    assert r["columns_match"], r
    assert r["types_match"], r
    assert r["values_match"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert len(df.columns) == 45
    assert df.count() > 0
