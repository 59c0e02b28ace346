"""Every registered query against its SQL, over whole tables."""

import os

import pytest

import __spark_entry__ as driver
from catalog_queries.oracles import ORACLES
from catalog_queries.queries import QUERIES
from tests.oracle import connect, differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    with connect(SF_DIR) as connection:
        yield connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    assert differences(spark, duck, SF_DIR, driver.queries()[name], driver.oracle_sql()[name]) is None


def test_entry_gives_links(spark):
    found = driver.entry(spark)
    assert found.columns == ["url", "record_id"]
    assert found.count() > 0
