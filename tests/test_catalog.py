"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.check_catalog import compare, database

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_matches_sql(spark, con, name):
    problem = compare(spark, con, FOLDER, entry.queries()[name], entry.oracle_sql().get(name))
    assert problem is None or problem == "no rows on either side"


def test_entry_runs(spark):
    assert entry.entry(spark).columns == ["row_index", "cardholder", "criteria", "highlight"]


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
