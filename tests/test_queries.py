"""Each query with SQL against DuckDB on the smallest tables."""

import os

import pytest

from checks import compare
from checks.oracles import ORACLES
from checks.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF_DIR):
        pytest.skip("driver tables are not here")
    return compare.duck(SF_DIR)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_equals_sql(spark, con, key):
    assert compare.difference(spark, con, SF_DIR, key) is None


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_has_rows(spark, con, key):
    assert not QUERIES[key](spark, SF_DIR).isEmpty()


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
