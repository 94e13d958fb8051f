"""Every registered query with SQL gives the same rows as DuckDB on the same tables."""

from __future__ import annotations

import pytest
from check import compare, connect

from shelfscout.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, folder, con, name):
    assert compare(QUERIES[name](spark, folder), con, ORACLES[name]) is None


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    from __spark_entry__ import entry, oracle_sql, queries

    assert entry(spark).count() == 3
    assert set(oracle_sql()) <= set(queries())
