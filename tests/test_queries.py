"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as contract
from eventloom.catalog import load
from compare import connect, differences, duck_rows, spark_rows

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    assert differences(spark_rows(QUERIES[name](spark, SF)), duck_rows(con, ORACLES[name])) is None


def test_every_catalogue_query_has_sql():
    assert set(load().QUERIES) <= set(ORACLES) <= set(QUERIES)


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
