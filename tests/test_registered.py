"""Every named query against its SQL on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_queries import compare, duck
from tslines.plans.registered import QUERIES


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(oracle_sql())
    assert set(oracle_sql()) <= set(queries())


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    assert compare(QUERIES[name](spark, sf_dir), con, oracle_sql()[name]) is None
