"""Every registered query against its SQL oracle on the smallest tables."""

import pytest
from oracle import compare, connect

import __spark_entry__ as contract

DIRECTORY = "/root/testdata/sf0.001"
QUERIES = contract.queries()
ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(DIRECTORY)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_oracle(spark, con, name):
    assert compare(QUERIES[name](spark, DIRECTORY), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs_and_repeats(spark, name):
    first = sorted(map(repr, QUERIES[name](spark, DIRECTORY).collect()))
    assert first
    assert first == sorted(map(repr, QUERIES[name](spark, DIRECTORY).collect()))


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["mode", "year", "month", "n", "otp_rate"]
    assert df.count() > 0
