"""Calendar rules as Column expressions.

One implementation serves both uses. A parameter (a Python date, a datetime or
ISO text) becomes a literal, which Catalyst folds to a constant before it plans
the scan, so window bounds still reach the parquet reader. A Column argument
applies the same rule to every row of a table.

Everything here works on ``timestamp_ntz`` values without going through a time
zone, so results do not depend on ``spark.sql.session.timeZone``.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

When = Column | date | datetime | str


def as_time(value: When) -> Column:
    """A parameter or column as ``timestamp_ntz``."""
    return _column(value).cast("timestamp_ntz")


def as_day(value: When) -> Column:
    """A parameter or column as ``date`` (the time of day is dropped)."""
    if isinstance(value, str | datetime):
        # Text may carry a time of day; read it all, then drop that part.
        return as_time(value).cast("date")
    return _column(value).cast("date")


def midnight(value: When) -> Column:
    """The start of the value's day, as ``timestamp_ntz``."""
    return as_day(value).cast("timestamp_ntz")


def add_days(value: When, days: int | Column) -> Column:
    """Shift a time by whole days, keeping the time of day."""
    count = F.lit(days) if isinstance(days, int) else days
    return as_time(value) + F.make_dt_interval(count)


def add_months(value: When, months: int) -> Column:
    """Shift a time by whole months; the day is cut to the last of a shorter month."""
    return as_time(value) + F.make_ym_interval(F.lit(0), F.lit(months))


def month_start(value: When, back: int = 0) -> Column:
    """First day of the month ``back`` months before the value's month."""
    return F.trunc(F.add_months(as_day(value), -back), "MM")


def month_last_day(value: When, back: int = 0) -> Column:
    """Last day of the month ``back`` months before the value's month."""
    return F.last_day(F.add_months(as_day(value), -back))


def seconds_between(earlier: When, later: When) -> Column:
    """Second boundaries crossed between two times (fractions are dropped first)."""
    a, b = as_time(earlier), as_time(later)
    return _days_between(a, b) * F.lit(86400).cast("bigint") + (
        _second_of_day(b) - _second_of_day(a)
    )


def hours_between(earlier: When, later: When) -> Column:
    """Hour boundaries crossed between two times."""
    a, b = as_time(earlier), as_time(later)
    return _days_between(a, b) * F.lit(24) + F.hour(b) - F.hour(a)


def months_between(earlier: When, later: When) -> Column:
    """Month boundaries crossed between two times (31 Jan to 1 Feb counts one)."""
    a, b = as_time(earlier), as_time(later)
    return (F.year(b) - F.year(a)) * F.lit(12) + F.month(b) - F.month(a)


def _column(value: When) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, datetime):
        if value.tzinfo is not None:
            raise ValueError("give a local time without a zone, for which the report counts days")
        # A datetime literal would be moved between time zones; its text is not.
        return F.lit(value.isoformat(" "))
    return F.lit(value)


def _days_between(a: Column, b: Column) -> Column:
    return F.datediff(b.cast("date"), a.cast("date"))


def _second_of_day(t: Column) -> Column:
    # second() of a timestamp with a fraction is the whole second.
    return F.hour(t) * F.lit(3600) + F.minute(t) * F.lit(60) + F.second(t)
