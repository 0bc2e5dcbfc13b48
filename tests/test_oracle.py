"""Every registered query against its SQL on the sample tables."""

import os

import pytest

import __spark_entry__ as driver
from oracle_compare import differences, duck
from retentide.plans import catalog, oracle

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLE = catalog.REGISTRY, oracle.build()
EMPTY_AT_SMALLEST = {"dq_silver_new_not_in_source"}


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(name, spark, con):
    found = differences(QUERIES[name], ORACLE[name], spark, SF_DIR, con)
    assert found == "" or (found == "no rows" and name in EMPTY_AT_SMALLEST)


def test_flagship_is_stable(spark):
    df = driver.entry(spark)
    assert df.columns == ["user_id", "user_state", "start_date", "end_date"]
    assert df.count() > 0
