"""Every core query that has SQL gives the rows of that SQL."""

import pytest

from storyloom.plans.all_queries import QUERIES, SQL
from storyloom.session import TABLES

from oracle import assert_same, connect


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf, TABLES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf, con, name):
    assert_same(QUERIES[name](spark, sf), con, SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_runs(spark, sf, name):
    assert QUERIES[name](spark, sf).count() >= 0
