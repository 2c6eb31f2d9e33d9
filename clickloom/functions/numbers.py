"""Casts that give NULL where the text is no number, and NULL-safe division."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMERIC = "decimal(38,9)"


def safe_numeric(value: Column) -> Column:
    """Text to a 38-digit number with 9 decimals, NULL where it is none."""
    return value.try_cast(NUMERIC)


def safe_integer(value: Column) -> Column:
    """Text to a 64-bit integer; ``'2.0'`` is not one."""
    return value.try_cast("bigint")


def safe_divide(dividend: Column, divisor: Column) -> Column:
    """Quotient at 9 decimals, NULL for a zero divisor."""
    return F.try_divide(dividend, divisor).cast(NUMERIC)


def inside(value: Column, low: float, high: float) -> Column:
    """The value if it lies in ``[low, high]``, else NULL."""
    return F.when(value.between(low, high), value)
