"""The same comparison when one customer, one part and one day hold a third of the rows each."""

import duckdb
import pytest

from grovemart.plans.queries import QUERIES
from tests.compare import assert_same, connect

SOURCE = "/root/testdata/sf0.001"
CHANGES = {
    "orders": """replace (
        case when o_orderkey % 3 = 0 then 7 else o_custkey end as o_custkey,
        case when o_orderkey % 3 = 1 then timestamp '1999-02-28' else o_orderdate end as o_orderdate)""",
    "lineitem": "replace (case when l_orderkey % 3 = 2 then 11 else l_partkey end as l_partkey)",
}


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    for name in ("region", "nation", "customer", "part", "orders", "lineitem"):
        columns = f"* {CHANGES.get(name, '')}"
        duckdb.execute(
            f"copy (select {columns} from '{SOURCE}/{name}.parquet') to '{folder}/{name}.parquet'"
        )
    return str(folder)


@pytest.fixture(scope="module", params=["10485760", "-1"], ids=["broadcasts", "no_broadcasts"])
def broadcasts(spark, request):
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for name in names:
        spark.conf.set(name, request.param)
    yield
    for name in names:
        spark.conf.unset(name)


@pytest.fixture(scope="module")
def duck(skewed):
    return connect(skewed)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_result(spark, duck, skewed, broadcasts, name):
    assert_same(spark, duck, name, skewed)
