"""Every registered query against its SQL on the given tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.compare import connect, spark_rows, sql_rows

FOLDER = os.environ.get("EARSHOT_TEST_FOLDER", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    """Those of the optional part have tests of their own instead where SQL cannot say the same."""
    assert set(entry.ORACLE) <= set(entry.queries())
    assert {q for q in entry.queries() if not q.startswith("op") and q != "pipeline"} == set(entry.ORACLE)


@pytest.mark.parametrize("name", list(entry.ORACLES))
def test_query_equals_sql(spark, con, name):
    assert spark_rows(entry.queries()[name](spark, FOLDER)) == sql_rows(con, entry.oracle_sql()[name])


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
