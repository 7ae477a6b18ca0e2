"""Every registered query against its SQL twin on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from mailloom.plans import oracle, queries as registered
from tests.compare import compare, connect
from tests.conftest import SF_SMALL

# Queries of optional parts are tested beside them.
QUERIES, SQL = registered.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_SMALL)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], SQL[name], SF_SMALL) is None
