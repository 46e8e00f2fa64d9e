"""Every SQL-checkable query equals its DuckDB oracle at sf0.01 (exact values)."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF01
from tests.oracle_harness import compare, duck_connection

NAMES = sorted(entry.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF01)


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, duck, name):
    got = entry.queries()[name](spark, SF01).toPandas()
    want = duck.sql(entry.oracle_sql()[name]).df()
    assert compare(got, want) == []


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "CustomerID"
