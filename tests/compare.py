"""Comparing a Spark result with the rows of its SQL."""

import math
from collections import Counter
from datetime import date
from decimal import Decimal

import duckdb

import __spark_entry__ as contract

TABLES = ["region", "nation", "customer", "part", "orders", "lineitem"]


def connect(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def _value(value):
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def _multiset(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def assert_same(spark, connection, name, sf_dir):
    result = contract.queries()[name](spark, sf_dir)
    relation = connection.sql(contract.oracle_sql()[name])
    assert sorted(result.columns) == sorted(relation.columns)
    expected = _multiset(relation.fetchall(), relation.columns)
    actual = _multiset(result.collect(), result.columns)
    assert sum(actual.values()) > 0
    assert actual == expected
