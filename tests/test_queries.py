"""Every registered query next to its SQL, on the smallest scale."""

import os

import pytest

import __spark_entry__ as contract
from check_queries import compare, database
from lake_queries import ORACLES, QUERIES

SCALE = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return database(SCALE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, name, SCALE) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).columns[:3] == ["vehicle_id", "parc_id", "time"]
