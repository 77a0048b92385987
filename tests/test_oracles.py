"""Every registered query against its SQL on the smallest test data."""

import os

import pytest

from __spark_entry__ import entry
from larder.catalogue import ORACLES, QUERIES
from tools.check_oracles import connect, difference

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    assert difference(spark, duck, SF, name) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_keeps_every_sale(spark):
    assert entry(spark).count() == spark.read.parquet(f"{SF}/orders.parquet").count()
