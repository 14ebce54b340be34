"""Every registered query against its SQL twin."""

import pytest

import __spark_entry__ as entry
from check_oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


# The queries of the training-data subpackage have tests of their own.
OWN = sorted(set(entry.queries()) - set(entry.LLM_QUERIES))


@pytest.mark.parametrize("name", OWN)
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, name, entry.queries()[name], entry.oracle_sql().get(name), SF) is None


def test_entry(spark):
    got = {r["event_type"]: r["unconsumed"] for r in entry.entry(spark).collect()}
    assert got["view"] is None and len(got) == 5


def test_every_query_has_sql():
    assert set(OWN) == set(entry.oracle_sql()) - set(entry.LLM_ORACLE)
