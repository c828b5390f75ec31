"""Scalar functions against values worked out by hand."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tradeloom.functions import dates, money, parse, text


def one(spark, value, kind, function):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(function(F.col("v")).alias("r")).first()["r"]


def many(spark, values, kind, function):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["r"] for r in df.select("i", function(F.col("v")).alias("r")).orderBy("i").collect()]


def test_text(spark):
    values = ["  a \t b\n", "x", "", None, " y z "]
    assert many(spark, values, "string", text.norm_text) == ["a b", "x", "", "", "y z"]
    assert one(spark, " web\tsite ", "string", text.norm_code) == "WEB SITE"
    assert many(spark, ["", " \t", None, "a"], "string", text.is_blank) == [True, True, True, False]


def test_numbers(spark):
    values = ["12", " 12.5 ", "+3", "-4e2", ".5", "5.", "1d", "1,000", "1_000", "0x1A", "", "nan",
              "inf", "-Infinity", None, "abc"]
    expected = [12.0, 12.5, 3.0, -400.0, 0.5, 5.0, None, None, None, None, None, None,
                float("inf"), float("-inf"), None, None]
    assert many(spark, values, "string", parse.parse_numeric) == expected
    exact = many(spark, ["0.1", " 1e3 ", "1f", "inf", "nan", "1,0"], "string", parse.parse_decimal)
    assert exact == [Decimal("0.1"), Decimal("1000"), None, None, None, None]


def test_dates(spark):
    cases = {
        "2020-01-15": date(2020, 1, 15), " 2020-1-5 ": date(2020, 1, 5), "20200115": date(2020, 1, 15),
        "01/02/2020": date(2020, 1, 2), "15/01/2020": date(2020, 1, 15), "Jan 5 2020": date(2020, 1, 5),
        "January 5, 2020": date(2020, 1, 5), "15-Mar-2021": date(2021, 3, 15), "15 mar 2021": date(2021, 3, 15),
        "2020": date(2020, 1, 1), "2020-03": date(2020, 3, 1), "2020-01-15T10:20:30Z": date(2020, 1, 15),
        "2020-01-15 10:20:30.5": date(2020, 1, 15), "2020/01/15": date(2020, 1, 15),
        "2020-02-30": None, "not-a-date": None, "": None, "2020-01-15 later": None, "2020-13-45": None,
        "13/13/2020": None,
        "01/02/20": date(2020, 1, 2), "05/06/87": date(1987, 5, 6), "01/15/2020 10:30": date(2020, 1, 15),
        "Jan 5 2020 10:00": date(2020, 1, 5), "2020/01": date(2020, 1, 1), "Jan 2020": date(2020, 1, 1),
        "Sun, 05 Jan 2020": date(2020, 1, 5), "20200115103000": date(2020, 1, 15), "Sept 5 2020": date(2020, 9, 5),
        "2020-01-15 10:30 PM": date(2020, 1, 15),
    }
    assert dict(zip(cases, many(spark, list(cases), "string", parse.parse_date))) == cases


def test_calendar(spark):
    df = spark.createDataFrame([(date(2005, 1, 1),), (date(2024, 12, 30),)], "d date")
    rows = [tuple(r) for r in df.select(*dates.calendar_columns(F.col("d"))).collect()]
    assert rows == [
        (20050101, date(2005, 1, 1), 1, "Saturday", 53, 1, "January", 1, 2005, True),
        (20241230, date(2024, 12, 30), 30, "Monday", 1, 12, "December", 4, 2024, False),
    ]
    assert one(spark, None, "date", dates.date_key) is None


def test_half_even_and_division(spark):
    values = [Decimal("0.125"), Decimal("0.135"), Decimal("-0.125"), Decimal("2.675")]
    assert many(spark, values, "decimal(10,3)", money.to_amount) == [
        Decimal("0.12"), Decimal("0.14"), Decimal("-0.12"), Decimal("2.68")]
    df = spark.createDataFrame([(1, 4.0, 2.0), (2, 4.0, 0.0), (3, 4.0, None), (4, None, 2.0)],
                               "i int, n double, d double")
    out = df.orderBy("i").select(money.safe_divide(F.col("n"), F.col("d")).alias("r")).collect()
    assert [r["r"] for r in out] == [2.0, 0.0, 0.0, None]


@pytest.mark.parametrize("start, end, seconds", [
    (datetime(2024, 1, 1, 0, 0, 0, 900000), datetime(2024, 1, 1, 0, 0, 1, 100000), 1),
    (datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 1), 60)])
def test_seconds_are_boundaries(spark, start, end, seconds):
    df = spark.createDataFrame([(start, end)], "a timestamp, b timestamp")
    assert df.select(dates.seconds_between(F.col("a"), F.col("b"))).first()[0] == seconds
