"""Every registered query against its SQL in another engine."""

import pytest
from compare import compare, oracle_connection

import __spark_entry__ as entry_module

SF_DIR = "/root/testdata/sf0.001"
ORACLES = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF_DIR)


def test_each_oracle_has_its_query():
    assert set(ORACLES) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, oracle, name):
    df = entry_module.queries()[name](spark, SF_DIR)
    assert compare(df, oracle, ORACLES[name]) == []


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
