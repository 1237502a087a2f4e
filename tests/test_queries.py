"""Registered queries against their SQL on the small tables."""

import os

import pytest

import __spark_entry__ as contract
from compare import connect, differences

SF_DIR = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")
QUERIES = contract.queries()
SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_runs(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0
