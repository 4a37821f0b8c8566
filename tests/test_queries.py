"""Every registered query against its SQL on the smallest tables."""

import os

import pytest
from oracle import connect, difference

from __spark_entry__ import QUERIES, SQL, entry

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are absent")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    problem, _ = difference(spark, con, QUERIES[name], SQL[name], SF)
    assert problem is None, problem
