"""Every registered query against its oracle on the smallest tables."""

import pytest

import __spark_entry__ as entry_point
from tests.oracle import check, connect

QUERIES, ORACLES = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def oracle(sf_dir):
    return connect(sf_dir)


def test_entry_and_registry(spark):
    assert set(ORACLES) <= set(QUERIES)
    result = entry_point.entry(spark)
    assert result.columns == [
        "feature", "segment", "client_count", "subscriber_count", "subscription_rate", "segment_rank",
    ]
    result.collect()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_oracle(spark, oracle, sf_dir, name):
    assert check(spark, oracle, name, QUERIES[name], ORACLES[name], sf_dir) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0
