"""Every registered query against its SQL, over the same files."""

import pytest

import __spark_entry__ as contract
from grovemart.plans.oracle import ORACLE_SQL
from grovemart.plans.queries import QUERIES
from tests.compare import assert_same, connect

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(ORACLE_SQL) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_result(spark, duck, name):
    assert_same(spark, duck, name, SF_DIR)


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert rows and contract.entry(spark).columns == ["ano", "area_ha"]
