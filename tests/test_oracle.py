"""Every registered query against its SQL twin."""

import pytest

import __spark_entry__ as registered
from tests import oracle

FOLDER = "/root/testdata/sf0.01"
QUERIES = registered.core_queries()
ORACLES = registered.oracle_queries.oracle_sql()


@pytest.fixture(scope="module")
def con():
    with oracle.connect(FOLDER) as connection:
        yield connection


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == {"sample_rows", "storage_report"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    oracle.compare(QUERIES[name](spark, FOLDER), con, ORACLES[name])


def test_entry_runs(spark):
    assert registered.entry(spark).count() == 10
