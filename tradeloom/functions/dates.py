"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def date_key(d: Column) -> Column:
    """``YYYYMMDD`` as an integer; NULL stays NULL."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def calendar_columns(d: Column) -> list[Column]:
    """The date dimension's columns for a date expression (ISO week, calendar year)."""
    return [
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.dayofmonth(d).alias("day_of_month"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.weekofyear(d).alias("week_number"),
        F.month(d).alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter_number"),
        F.year(d).alias("year"),
        (F.weekday(d) >= 5).alias("is_weekend"),
    ]


def hierarchy_columns(d: Column) -> list[Column]:
    """Year > quarter > month > day columns of a report date hierarchy."""
    return [
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter_no"),
        F.concat(F.lit("Qtr "), F.quarter(d).cast("string")).alias("quarter"),
        F.month(d).alias("month_no"),
        F.date_format(d, "MMMM").alias("month"),
        F.dayofmonth(d).alias("day"),
    ]


def year_month(year: Column, month: Column) -> Column:
    """``YYYY-MM`` label."""
    return F.concat_ws(
        "-", F.lpad(year.cast("string"), 4, "0"), F.lpad(month.cast("string"), 2, "0")
    )


def seconds_between(start: Column, end: Column) -> Column:
    """Whole-second boundaries crossed between two timestamps."""
    return F.unix_seconds(end) - F.unix_seconds(start)
