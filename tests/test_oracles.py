"""Every query against its oracle, on the tables and scale the driver checks."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle_check import connect, difference

TABLES = "/root/testdata/sf0.01"
QUERIES, ORACLES = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(TABLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    assert difference(QUERIES[name](spark, TABLES), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_oracle_gives_rows(spark, name):
    assert QUERIES[name](spark, TABLES).count() > 0


def test_entry(spark):
    assert entry(spark).count() == 1
