"""Report windows and ranges, resolved from parameters or from table columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ringledger.functions.dates import (
    When,
    add_days,
    add_months,
    as_day,
    as_time,
    midnight,
    month_last_day,
    month_start,
)


@dataclass(frozen=True)
class Window:
    """A span of time. ``stop`` is outside it, unless the window is closed."""

    start: Column
    stop: Column
    closed: bool = False

    def covers(self, moment: Column) -> Column:
        if self.closed:
            return moment.between(self.start, self.stop)
        return (moment >= self.start) & (moment < self.stop)


@dataclass(frozen=True)
class MonthWindows:
    """Windows of the monthly retention report, with its two printed dates.

    ``current`` and ``prior`` are the months compared; ``overall`` limits the
    calls that count at all. Use ``dataclasses.replace`` to override any of them.
    """

    overall: Window
    current: Window
    prior: Window
    report_start: Column
    report_end: Column


def month_windows(end_date: When, closed_dates: bool = False) -> MonthWindows:
    """The month of ``end_date``, the month before it, and the two together.

    By default a month runs up to the start of the next. ``closed_dates`` instead
    ends it at midnight of its last day, inclusive: the literal reading of a closed
    range between two dates, which leaves out calls later on that day.
    """

    def stop(back: int) -> Column:
        if closed_dates:
            return month_last_day(end_date, back).cast("timestamp_ntz")
        return month_start(end_date, back - 1).cast("timestamp_ntz")

    def start(back: int) -> Column:
        return month_start(end_date, back).cast("timestamp_ntz")

    return MonthWindows(
        overall=Window(start(1), stop(0), closed_dates),
        current=Window(start(0), stop(0), closed_dates),
        prior=Window(start(1), stop(1), closed_dates),
        report_start=month_start(end_date, 1),
        report_end=add_months(end_date, 1),
    )


def resolve_range(
    start: When | None = None,
    end: When | None = None,
    month_to_date: bool = False,
    days_ago: int | Column | None = 1,
    *,
    now: When | None = None,
) -> Window:
    """Range of the performance report. Its end moves to the next day, exclusive.

    With no start, the range is the month to date through yesterday, or the one
    day ``days_ago`` days before ``now``; a given end is then ignored.
    """
    if start is not None:
        if end is None:
            raise ValueError("A start date needs an end date.")
        return Window(as_time(start), add_days(end, 1))
    if now is None:
        raise ValueError("Without a start date, pass the current time as now.")
    if month_to_date:
        last = add_days(midnight(now), -1)
        return Window(month_start(last).cast("timestamp_ntz"), add_days(last, 1))
    back = 1 if days_ago is None else days_ago
    day = add_days(midnight(now), -back)
    return Window(day, add_days(day, 1))


@dataclass(frozen=True)
class DayRange:
    """First and last day of the problem report, both included."""

    first: Column
    last: Column

    @property
    def reports(self) -> Window:
        """When a problem report must have been created."""
        return Window(midnight(self.first), add_days(midnight(self.last), 1))

    @property
    def calls(self) -> Window:
        """When a call must have been handed off. Midnight after the last day counts."""
        return Window(midnight(self.first), add_days(midnight(self.last), 1), closed=True)


def csc_range(
    start: When | None = None, end: When | None = None, *, now: When | None = None
) -> DayRange:
    """Range of the problem report.

    With no dates it is the month to date through yesterday, or on the first of a
    month the whole month before. Dates are cut to the day.
    """
    if (start is None) != (end is None):
        raise ValueError("Pass both dates or neither.")
    if start is not None:
        return DayRange(as_day(start), as_day(end))
    if now is None:
        raise ValueError("Without dates, pass the current time as now.")
    today = as_day(now)
    first_of_month = F.dayofmonth(today) == 1
    return DayRange(
        F.when(first_of_month, month_start(today, 1)).otherwise(month_start(today)),
        F.date_sub(today, 1),
    )
