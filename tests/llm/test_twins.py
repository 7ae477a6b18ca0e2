"""Queries that SQL can express against their twins, on the smallest tables."""

from __future__ import annotations

import pytest

from mailloom.llm import queries
from tests.compare import compare, connect
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_twin(spark, name):
    assert compare(spark, connect(SF_SMALL), name, queries.queries()[name], queries.oracle_sql()[name], SF_SMALL) is None
