"""Date expressions: integer keys, academic year, season."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, functions as F

# Bounds of open validity intervals and of the first extraction.
OPEN_END = date(9999, 12, 31)
FIRST_WATERMARK = datetime(1900, 1, 1)

# Default calendar range.
CALENDAR_START = date(2021, 1, 1)
CALENDAR_END = date(2030, 12, 31)

# Months of the two teaching seasons; the rest is vacation.
FIRST_SEMESTER_MONTHS = (9, 10, 11, 12, 1)
SECOND_SEMESTER_MONTHS = (2, 3, 4, 5, 6)
ACADEMIC_YEAR_FIRST_MONTH = 9


def date_key(day: Column) -> Column:
    """YYYYMMDD as int."""
    day = day.cast("date")
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def days_between(start: Column, end: Column) -> Column:
    """Whole days from ``start`` to ``end``."""
    return F.datediff(end.cast("date"), start.cast("date"))


def academic_year(day: Column) -> Column:
    first = F.year(day) - (F.month(day) < ACADEMIC_YEAR_FIRST_MONTH).cast("int")
    return F.concat_ws("/", first.cast("string"), (first + 1).cast("string"))


def season(day: Column) -> Column:
    month = F.month(day)
    return (
        F.when(month.isin(*FIRST_SEMESTER_MONTHS), "First Semester")
        .when(month.isin(*SECOND_SEMESTER_MONTHS), "Second Semester")
        .otherwise("Vacation")
    )


def seconds_between(start: Column, end: Column) -> Column:
    """Second boundaries crossed from ``start`` to ``end``."""
    whole = lambda c: F.date_trunc("second", c)
    return F.timestamp_diff("SECOND", whole(start), whole(end))
