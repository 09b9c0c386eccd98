"""Every registered query against its SQL on the given tables."""

import os

import pytest

import __spark_entry__ as contract
from compare import duck, duck_rows, spark_rows
from tillbook.plans import catalog

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(catalog.queries()) <= set(SQL) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_sql(spark, con, name):
    names, rows = spark_rows(contract.queries()[name](spark, SF_DIR))
    expected_names, expected = duck_rows(con, SQL[name])
    assert names == expected_names
    assert len(rows) == len(expected)
    assert rows == expected


def test_entry(spark):
    assert contract.entry(spark).count() > 0
