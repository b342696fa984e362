"""The registered queries: all rows of the SQL, and the contract of the entry file."""

import duckdb
import pytest

import __spark_entry__ as contract
from grovemart.llm.oracle import ORACLE_SQL
from grovemart.llm.queries import QUERIES
from tests.compare import _multiset

TABLES = ["documents", "embeddings", "pages", "labels"]


def test_registered():
    assert {*QUERIES, "pipeline"} <= set(contract.queries())
    assert [f"op{n}" for n in range(1, 14)] == sorted((q.split("_")[0] for q in QUERIES), key=lambda q: int(q[2:]))
    assert set(ORACLE_SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_as_sql(spark, name):
    sf_dir = "/root/testdata/sf0.001"
    duck = duckdb.connect()
    for table in TABLES:
        duck.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    expected = duck.sql(ORACLE_SQL[name])
    result = QUERIES[name](spark, sf_dir)
    assert sorted(result.columns) == sorted(expected.columns)
    assert _multiset(result.collect(), result.columns) == _multiset(expected.fetchall(), expected.columns)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_one_row_per_input_row(spark, name):
    sf_dir = "/root/testdata/sf0.001"
    rows = QUERIES[name](spark, sf_dir)
    key = "page_id" if "page_id" in rows.columns else "doc_id"
    table = spark.read.parquet(f"{sf_dir}/{'pages' if key == 'page_id' else 'documents'}.parquet")
    assert rows.select(key).distinct().count() == table.count()
    if "start" not in rows.columns:
        assert rows.count() == table.count()
