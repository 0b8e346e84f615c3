"""Scalar Column expressions. All are built-in functions, so they stay inside generated code."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fixed


def lenient_date(col: Column) -> Column:
    """Date of the value; NULL where it is not a date (a plain cast raises under ANSI mode)."""
    return col.try_cast("date")


def lenient_double(col: Column) -> Column:
    return col.try_cast("double")


def lenient_int(col: Column) -> Column:
    """Integer part of the number; by way of double, because ``try_cast('23.0' AS INT)`` is NULL."""
    return col.try_cast("double").try_cast("int")


def date_key(day: Column) -> Column:
    """20240131 for 31 January 2024."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def year_of(key: Column) -> Column:
    """The year of a date_key."""
    return F.floor(key / 10000).cast("int")


def season_of(day: Column) -> Column:
    tag = F.lit(fixed.SEASON_OTHERWISE)
    for name, months in fixed.SEASONS.items():
        tag = F.when(F.month(day).isin(*months), name).otherwise(tag)
    return tag


def month_boundaries(start: Column, end: Column) -> Column:
    """Number of month starts after ``start`` up to ``end``: 1 from 31 January to 1 February.

    ``timestampdiff`` and ``months_between`` count elapsed months instead.
    """
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)
