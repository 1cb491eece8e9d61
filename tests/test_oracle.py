"""Every registered query gives the rows, names and types of its SQL."""

import pytest

import __spark_entry__ as entry
import oracle_queries
from ballotlake.registry import QUERIES
from compare import compare, duck

ORACLES = oracle_queries.oracle_sql()


@pytest.fixture(scope="module")
def connection(sf):
    return duck(sf)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, connection, name):
    assert compare(QUERIES[name](spark, sf), connection, ORACLES[name]) == []


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
