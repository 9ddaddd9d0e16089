"""Every registered query against its SQL, on the smallest test tables."""

import pytest

import __spark_entry__ as contract
from queries import QUERIES
from tests import oracle

FOLDER, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


@pytest.fixture(scope="module")
def larger():
    return oracle.connect(LARGER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, con, larger, name):
    query = QUERIES[name]
    assert query.sql is not None
    found = oracle.difference(spark, con, query, FOLDER)
    if found == "no rows":  # too few rows in the smallest tables for this one
        found = oracle.difference(spark, larger, query, LARGER)
    assert found is None


def test_contract(spark):
    assert set(QUERIES) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.oracle_sql())
    df = contract.entry(spark)
    assert df.count() == 150
    assert df.columns[:3] == ["id", "status", "name"]
