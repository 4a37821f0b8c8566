"""Text queries with SQL against DuckDB on the smallest tables."""

import pytest
from helpers import SF
from oracle import connect, difference

from gaugeworks.llm import queries


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query(spark, name):
    problem, rows = difference(spark, connect(SF), queries.QUERIES[name], queries.SQL[name], SF)
    assert problem is None and rows > 0
