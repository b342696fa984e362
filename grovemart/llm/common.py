"""Helpers shared by the operators."""

from __future__ import annotations

import sys
from collections.abc import Callable, Hashable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from grovemart.session import run_dir

#: A word: everything between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: lineage ends here, executors may be lost."""
    spark: SparkSession = df.sparkSession
    path = run_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def once(key: Hashable, make: Callable[[], Any]) -> Any:
    """A value made once in every Python process.

    It is kept beside the interpreter and not in this package, whose functions travel by value:
    a decorated function or a module's own dictionary would travel by name, or with its contents.
    """
    kept = sys.__dict__.setdefault("_grovemart_once", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_words(text: Column) -> Column:
    """Number of words; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def n_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def before(group: list[str], order: list[str], value: str) -> Column:
    """Sum of `value` over the rows of the group that come earlier."""
    earlier = Window.partitionBy(*group).orderBy(*order)
    rows = earlier.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(rows), F.lit(0))


def set_aside(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """`df` with columns named c0, c1 ..., and these by the old names: no name of it can clash."""
    names = {name: f"c{i}" for i, name in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def put_back(names: dict[str, str], own: list[str]) -> list[Column]:
    """The columns that were set aside, less those of the operator's own names (in any case)."""
    taken = {name.lower() for name in own}
    return [F.col(now).alias(name) for name, now in names.items() if name.lower() not in taken]
