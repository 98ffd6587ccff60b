"""Every registered query against its SQL on the smallest tables."""

import os

import pytest
from oracle_check import compare, connect

from __spark_entry__ import entry, oracle_sql, queries

FOLDER = os.environ.get("SHELFWISE_TESTDATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not there")
SQL = oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, duck, name):
    """Equal to its SQL and not empty; a query that SQL cannot express has brute-force tests of its own."""
    if name in SQL:
        problem = compare(spark, duck, name, queries()[name], SQL[name], FOLDER)
        if problem == "no rows":  # the smallest tables have none of some cases
            larger = FOLDER.replace("sf0.001", "sf0.01")
            problem = compare(spark, connect(larger), name, queries()[name], SQL[name], larger)
        assert problem is None
    else:
        assert not queries()[name](spark, FOLDER).isEmpty()


def test_entry(spark):
    assert "hours_played" in entry(spark).columns
