"""Epoch and calendar expressions that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_timestamp(seconds: Column) -> Column:
    """UTC wall-clock timestamp of epoch seconds."""
    epoch = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    return epoch + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def epoch_date(seconds: Column) -> Column:
    """UTC calendar day of epoch seconds."""
    return F.date_from_unix_date(F.floor(seconds / F.lit(86400)).cast("int"))


def date_key(day: Column) -> Column:
    """``YYYYMMDD`` as a number."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("bigint")


def week_from_sunday(day: Column) -> Column:
    """Week number 0..53; week 1 begins on the year's first Sunday."""
    days_since_sunday = F.dayofweek(day) - 1
    return F.floor((F.dayofyear(day) + 6 - days_since_sunday) / 7).cast("bigint")
