"""Calendar attributes and date ranges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from grovemart.schema import CALENDAR_FORMATS


def calendar_attributes(day: Column) -> dict[str, Column]:
    """Year, month, day, year-month and year-quarter of a date, as zero-padded text."""
    return {name: F.date_format(day, pattern) for name, pattern in CALENDAR_FORMATS.items()}


def each_day(first: Column, last: Column) -> Column:
    """One row per day from first to last; no row when a bound is NULL."""
    return F.explode(F.sequence(first, last))
