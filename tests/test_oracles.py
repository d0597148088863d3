"""Every registered query against its DuckDB oracle (as the driver checks)."""

import os

import pytest
from oracle_check import compare, duck

import __spark_entry__ as E

SF = os.environ.get("TOLLSTREAM_TEST_SF", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    assert compare(spark, name, E.queries()[name], E.oracle_sql()[name], con, SF)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["offset", "vid", "time", "lav", "num_vehicles", "toll"]
    assert df.count() == 325
