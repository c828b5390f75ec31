"""Money arithmetic on decimals, rounded half to even at every stored amount."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tradeloom.contracts import AMOUNT


def to_amount(c: Column) -> Column:
    """Round half to even to two places and store as a load amount."""
    return F.bround(c, 2).cast(AMOUNT)


def percent_of(amount: Column, percent: Column) -> Column:
    """``amount * percent / 100`` without leaving decimal arithmetic."""
    return amount * percent * F.lit("0.01").cast("decimal(3,2)")


def safe_divide(numerator: Column, denominator: Column, alternate: float = 0.0) -> Column:
    """Division for ratios: a zero or missing denominator yields ``alternate``,
    a missing numerator over a usable denominator stays missing."""
    n = numerator.cast("double")
    d = denominator.cast("double")
    return F.when(d.isNull() | (d == 0), F.lit(float(alternate))).otherwise(n / d)
