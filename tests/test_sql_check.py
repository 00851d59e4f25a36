"""Every registered query gives the same columns, types and values as its SQL."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tallyworks.registry.oracle import ORACLE
from tallyworks.registry.queries import QUERIES
from tests.comparison import compare, connect
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_same_result(spark, con, key):
    problems, _ = compare(QUERIES[key](spark, SMALL), con, ORACLE[key])
    assert not problems, problems


def test_entry(spark):
    assert entry(spark).count() == 3
