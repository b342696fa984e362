"""Counts, previews and checks that run beside the loads."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grovemart.schema import CORRUPT_RECORD, LOCATION_KEY, SPECIES_KEY


def count_report(stages: dict[str, DataFrame]) -> DataFrame:
    """One row per stage with its row count."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("registros")).select(F.lit(name).alias("etapa"), "registros")
        for name, df in stages.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """The first n rows by all columns, so that every run shows the same ones."""
    return df.orderBy(*df.columns).limit(n)


def duplicate_keys(dimension: DataFrame, key: str = LOCATION_KEY) -> DataFrame:
    """Keys with more than one dimension row; a plain join would count their facts twice."""
    return dimension.groupBy(key).agg(F.count(F.lit(1)).alias("linhas")).where("linhas > 1")


def orphan_keys(fact: DataFrame, dimension: DataFrame, key: str = LOCATION_KEY) -> DataFrame:
    """Fact keys without a dimension row, with their facts and area.

    A left join with a marker instead of an anti join: Spark would move an anti join below
    the sums and shuffle every fact, a third of them to one task if a key is that common.
    """
    sums = fact.groupBy(key).agg(
        F.count(F.lit(1)).alias("fatos"), F.sum("area_ha").alias("area_ha")
    )
    known = dimension.select(key).distinct().withColumn("known", F.lit(True))
    return sums.join(known, key, "left").where(F.col("known").isNull()).drop("known")


#: What of the null profile is counted beside the rows.
NULL_METRICS = {"datas": "data_base", "areas": "area_ha", "especies": SPECIES_KEY}


def null_metrics() -> dict[str, Column]:
    """The null profile as counts that a write can observe."""
    return {name: F.count(column) for name, column in NULL_METRICS.items()}


def null_profile(registry: DataFrame) -> DataFrame:
    """How many rows have a date, an area and a species after typing."""
    return registry.agg(F.count(F.lit(1)).alias("registros"), *[c.alias(n) for n, c in null_metrics().items()])


def ragged_rows(raw: DataFrame) -> DataFrame:
    """Raw rows with too few or too many fields, from a read that kept corrupt records."""
    return raw.where(F.col(CORRUPT_RECORD).isNotNull())
