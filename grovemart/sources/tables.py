"""Parquet tables: the system of record for every stage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grovemart.sources.files import literal


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet table; with a schema, Spark opens no footer to plan the read."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(literal(path))


def replace_table(df: DataFrame, path: str) -> int:
    """Write `df` over `path` and return its row count, observed during that one write."""
    return write_observed(df, path, {})["rows"]


def write_observed(df: DataFrame, path: str, metrics: dict[str, Column]) -> dict[str, int]:
    """Write `df` over `path`; its row count, as `rows`, and other sums over its rows, all seen in that one write."""
    seen = Observation()
    wanted = {"rows": F.count(F.lit(1)), **metrics}
    df.observe(seen, *[one.alias(name) for name, one in wanted.items()]).write.mode("overwrite").parquet(path)
    return {name: seen.get[name] for name in wanted}


def list_paths(spark: SparkSession, paths: str | list[str], pattern: str = "*") -> DataFrame:
    """Files below some folders with path, time and size; contents are not read.

    Spark would plan a task per half gigabyte of files that nobody opens; as many tasks as
    there are cores will do.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(paths)
    )
    return files.select("path", "modificationTime", "length").coalesce(
        spark.sparkContext.defaultParallelism
    )
