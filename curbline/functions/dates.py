"""Month and day helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def date_text(value: Column) -> Column:
    """Date or timestamp as YYYY-MM-DD."""
    return F.date_format(value, "yyyy-MM-dd")


def first_day(year_month: Column) -> Column:
    return F.to_date(F.concat(year_month, F.lit("-01")))


def days_in_month(year_month: Column) -> Column:
    return F.day(F.last_day(first_day(year_month)))


def month_days(months: DataFrame, year_month: str = "year_month", day: str = "trip_date") -> DataFrame:
    """One row per calendar day of each month."""
    first = first_day(F.col(year_month))
    return months.select(year_month, F.explode(F.sequence(first, F.last_day(first))).alias(day))
