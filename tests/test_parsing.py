import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from grovemart.functions.parsing import parse_date, parse_int

AREAS = {
    "12": 12,
    "12.7": 12,
    "-12.7": -12,
    "1.234": 1,
    "1234,5": None,
    "": None,
    " 7 ": 7,
    "abc": None,
    "-": None,
    "NaN": None,
    "2147483647": 2147483647,
    "2147483648": None,
    "-2147483648": -2147483648,
    "1e3": None,
    "5.": 5,
    "+5": 5,
    "007": 7,
    ".5": 0,
    "-.5": 0,
    "+.5": 0,
    ".": 0,
    "+": None,
    "1 2": None,
    "\t8\n": 8,
    "１２": None,
    "12\u0085": None,
    "12\u2028": None,
    "12\n": 12,
    "12.5\u0085": None,
    ".5\u2029": None,
    None: None,
}

DATES = {
    "01/02/2013": "2013-02-01",
    "29/02/2016": "2016-02-29",
    "1/2/2013": None,
    "2013-02-01": None,
    "01/01/+99999": None,
    "01/01/-0005": None,
    "01/01/12013": None,
    "01/01/0005": "0005-01-01",
    "01/02/2013\n": None,
    " 01/02/2013": None,
    "０1/02/2013": None,
    "31/02/2013": None,
    "29/02/2013": None,
    "": None,
    "x": None,
    None: None,
}


def _apply(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    result = df.select("i", expression(F.col("v")).cast("string").alias("r")).collect()
    found = {row["i"]: row["r"] for row in result}
    return [found[i] for i in range(len(values))]


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield request.param
    spark.conf.set("spark.sql.ansi.enabled", before)


def test_golden_areas(spark, ansi):
    expected = [None if v is None else str(v) for v in AREAS.values()]
    assert _apply(spark, list(AREAS), parse_int) == expected


def test_golden_dates(spark, ansi):
    assert _apply(spark, list(DATES), parse_date) == list(DATES.values())


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="0123456789+-. eE\t\x00\x7fa,_", max_size=13), min_size=100, max_size=200))
def test_areas_equal_a_cast_without_ansi(spark, values):
    tolerant = _apply(spark, values, parse_int)
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        legacy = _apply(spark, values, lambda c: c.cast("int"))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert tolerant == legacy
