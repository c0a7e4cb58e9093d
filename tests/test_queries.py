"""Every registered query against its DuckDB oracle (the driver's gate, at sf0.001)."""

import pytest

import __spark_entry__ as entry
from darkroom.plans.registry import all_queries
from oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()
#: The optional training-data queries have their own tests.
OWN = sorted(all_queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "parent_id" in df.columns


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(ORACLES) and set(OWN) <= set(entry.queries())


@pytest.mark.parametrize("name", OWN)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    assert compare(df, con, ORACLES[name]) == []
