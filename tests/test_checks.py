"""Every registered query against its oracle on the smallest test tables, without cross joins."""

import os
from decimal import Decimal

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.all_checks import ORACLES, QUERIES
from checks.compare import compare, oracle_connection, plain

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF_DIR)


@needs_data
@pytest.mark.parametrize("key", list(QUERIES))
def test_query_matches_oracle(spark, connection, key):
    report = compare(spark, SF_DIR, key, QUERIES[key], ORACLES.get(key), connection)
    assert report["ok"], report["why"]
    for join in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert join not in report["plan"]


def test_oracles_belong_to_queries():
    assert set(oracle_sql()) <= set(queries())
    assert set(ORACLES) == set(QUERIES) <= set(queries())


def test_numbers_are_compared_exactly():
    assert plain(1_700_000_000_307) != plain(1_700_000_000_308)
    assert plain(Decimal("1234567890.01")) != plain(Decimal("1234567890.02"))
    assert plain(Decimal("2.50")) == plain(Decimal("2.5")) and plain(3) == plain(3.0) == plain(Decimal("3.00"))
    assert plain(0.1 + 0.2) == plain(0.3)


@needs_data
def test_entry(spark):
    assert entry(spark).count() > 0
