"""Raw columns to the clean and the typed registry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grovemart.functions.parsing import parse_date, parse_int
from grovemart.schema import COLUMN_NAMES, MISSING_AREA


def rename_columns(raw: DataFrame) -> DataFrame:
    return raw.withColumnsRenamed(COLUMN_NAMES)


def fill_missing_area(df: DataFrame) -> DataFrame:
    """A missing area is zero. The fill is text: a number would skip this text column."""
    return df.na.fill(MISSING_AREA, ["area_ha"])


def clean(raw: DataFrame) -> DataFrame:
    return fill_missing_area(rename_columns(raw))


def typed(df: DataFrame) -> DataFrame:
    """Clean text to the typed registry. Area and date text that does not parse is NULL."""
    return df.withColumns(
        {"area_ha": parse_int(F.col("area_ha")), "data_base": parse_date(F.col("data_base"))}
    )
