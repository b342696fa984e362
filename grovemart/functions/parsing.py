"""Tolerant text parsing: bad input gives NULL, never an error, with ANSI on or off."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whole numbers with an optional fraction, which is cut off. The blanks are the
# characters a cast trims: ASCII controls, space and DEL. The end is that of the text: a
# closing line separator is a character like others.
INTEGER_PATTERN = r"\A[\x00-\x20\x7F]*([+-]?[0-9]+)([.][0-9]*)?[\x00-\x20\x7F]*\z"
BARE_FRACTION_PATTERN = r"\A[\x00-\x20\x7F]*[+-]?[.][0-9]*[\x00-\x20\x7F]*\z"
# The formatter would take a sign and more digits for the year.
DATE_PATTERN = r"\A[0-9]{2}/[0-9]{2}/[0-9]{4}\z"


def parse_int(text: Column) -> Column:
    """Text to int, cutting a fraction off; NULL when it is no number or out of range.

    Same values as a cast with ANSI off. Whole numbers, with the same blanks, are taken by the
    cast itself; the patterns only run on text that it rejects. A fraction without a whole part is 0.
    """
    whole = F.regexp_extract(text, INTEGER_PATTERN, 1).try_cast("int")
    return F.coalesce(text.try_cast("int"), whole, F.when(F.rlike(text, F.lit(BARE_FRACTION_PATTERN)), F.lit(0)))


def parse_date(text: Column) -> Column:
    """Text to date; NULL unless it is two, two and four digits that name a day."""
    iso = F.concat_ws("-", F.substring(text, 7, 4), F.substring(text, 4, 2), F.substring(text, 1, 2))
    return F.when(F.rlike(text, F.lit(DATE_PATTERN)), iso.try_cast("date"))
