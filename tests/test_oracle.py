"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest
from oracle_check import compare, connect

from weftgraph.catalog import all_oracles, all_queries

QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, small, con, name):
    assert compare(QUERIES[name](spark, small), con, ORACLES[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_runs(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["part_id", "name", "n"]
