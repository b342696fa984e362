"""The four star tables from the typed registry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grovemart.functions.dates import calendar_attributes, each_day
from grovemart.schema import (
    DIM_CALENDAR,
    DIM_LOCATION,
    DIM_SPECIES,
    FACT_AREA,
    FACT_COLUMNS,
    LOCATION_COLUMNS,
    LOCATION_KEY,
    LOCATION_SCHEMA,
    SPECIES_KEY,
)


def dim_location(registry: DataFrame) -> DataFrame:
    """Every distinct combination of the nine location columns."""
    return registry.select(*LOCATION_COLUMNS).distinct()


def one_row_per_key(dimension: DataFrame, key: str = LOCATION_KEY) -> DataFrame:
    """The dimension with unique keys: of several rows for a key, the greatest as a whole.

    Taking the maximum of one struct never mixes attributes of two rows.
    """
    attributes = [name for name in dimension.columns if name != key]
    return (
        dimension.groupBy(key)
        .agg(F.max(F.struct(*attributes)).alias("chosen"))
        .select(key, "chosen.*")
    )


def unique_locations(dimension: DataFrame) -> DataFrame:
    """The location dimension with unique keys, in the columns that the cards ask for."""
    return one_row_per_key(dimension).select(*LOCATION_SCHEMA.fieldNames())


def date_bounds(registry: DataFrame) -> DataFrame:
    return registry.agg(
        F.min("data_base").alias("data_inicial"), F.max("data_base").alias("data_final")
    )


def calendar(bounds: DataFrame) -> DataFrame:
    """Every day between two dates, with its attributes. As many rows as days, whatever the data."""
    days = bounds.select(each_day(F.col("data_inicial"), F.col("data_final")).alias("data"))
    return days.withColumns(calendar_attributes(F.col("data")))


def dim_calendar(registry: DataFrame) -> DataFrame:
    return calendar(date_bounds(registry))


def dim_species(registry: DataFrame) -> DataFrame:
    """Every species; rows without one give a NULL member."""
    return registry.select(SPECIES_KEY).distinct()


def fact_area(registry: DataFrame) -> DataFrame:
    """One fact per registry row, neither merged nor dropped."""
    return registry.select(*FACT_COLUMNS)


def star(registry: DataFrame) -> dict[str, DataFrame]:
    return {
        DIM_LOCATION: dim_location(registry),
        DIM_CALENDAR: dim_calendar(registry),
        DIM_SPECIES: dim_species(registry),
        FACT_AREA: fact_area(registry),
    }
