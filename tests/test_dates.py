from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from ringledger.functions import dates
from ringledger.operators.windows import csc_range, month_windows, resolve_range
from tests.conftest import at


def value(spark, column):
    return spark.range(1).select(column.alias("v")).collect()[0].v


@pytest.mark.parametrize(
    "earlier, later, months",
    [
        ("2024-01-31", "2024-02-01", 1),
        ("2024-01-01", "2024-01-31", 0),
        ("2023-12-31 23:59:59", "2024-01-01", 1),
        ("2024-03-01", "2023-12-31", -3),
    ],
)
def test_months_are_boundaries(spark, earlier, later, months):
    assert value(spark, dates.months_between(earlier, later)) == months


def test_hours_and_seconds_are_boundaries(spark):
    assert value(spark, dates.hours_between("2024-01-01 00:59:59", "2024-01-01 01:00:00")) == 1
    assert value(spark, dates.hours_between("2024-01-01 00:00:00", "2024-01-01 00:59:59")) == 0
    a, b, c = [f"2024-01-01 00:00:0{second}" for second in ("0.1", "0.9", "1.1")]
    assert value(spark, dates.seconds_between(a, b)) == 0
    assert value(spark, dates.seconds_between(b, c)) == 1
    assert value(spark, dates.seconds_between("2024-01-02", "2024-01-01 23:59:30")) == -30
    assert value(spark, dates.seconds_between(F.lit(None), "2024-01-01")) is None


def test_month_ends_are_clamped(spark):
    assert value(spark, dates.add_months("2024-01-31 10:20:30", 1)) == at("2024-02-29 10:20:30")
    assert value(spark, dates.month_start("2024-03-31", 1)) == date(2024, 2, 1)
    assert value(spark, dates.month_last_day("2024-03-31", 1)) == date(2024, 2, 29)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Pacific/Auckland"])
def test_no_rule_depends_on_the_session_zone(spark, conf, zone):
    conf("spark.sql.session.timeZone", zone)
    # Clocks change in New York between these times.
    a, b = datetime(2024, 3, 10, 1, 30), datetime(2024, 3, 10, 3, 30)
    assert value(spark, dates.seconds_between(a, b)) == 7200
    assert value(spark, dates.hours_between(a, b)) == 2
    assert value(spark, dates.midnight(b)) == at("2024-03-10")
    assert value(spark, dates.as_time(b)) == b
    assert value(spark, dates.add_days(a, 1)) == at("2024-03-11 01:30")
    assert value(spark, dates.as_day(datetime(2024, 3, 10, 23, 30))) == date(2024, 3, 10)


def bounds(spark, window):
    row = spark.range(1).select(window.start.alias("a"), window.stop.alias("b")).collect()[0]
    return row.a, row.b


def test_month_windows(spark):
    windows = month_windows(date(2024, 3, 31))
    assert bounds(spark, windows.overall) == (at("2024-02-01"), at("2024-04-01"))
    assert bounds(spark, windows.current) == (at("2024-03-01"), at("2024-04-01"))
    assert bounds(spark, windows.prior) == (at("2024-02-01"), at("2024-03-01"))
    assert value(spark, windows.report_start) == date(2024, 2, 1)
    assert value(spark, windows.report_end) == at("2024-04-30")


def test_closed_month_ends_at_midnight_of_its_last_day(spark):
    windows = month_windows("2024-03-15", closed_dates=True)
    assert bounds(spark, windows.current) == (at("2024-03-01"), at("2024-03-31"))
    assert bounds(spark, windows.prior) == (at("2024-02-01"), at("2024-02-29"))
    moments = spark.createDataFrame(
        [(at("2024-03-31 00:00:00"),), (at("2024-03-31 00:00:01"),)], "t timestamp_ntz"
    )
    assert [r[0] for r in moments.select(windows.current.covers(F.col("t"))).collect()] == [
        True,
        False,
    ]


def test_performance_range(spark):
    now = "2024-03-01 08:30:00"
    assert bounds(spark, resolve_range("2024-01-05", "2024-01-06")) == (
        at("2024-01-05"),
        at("2024-01-07"),
    )
    assert bounds(spark, resolve_range(month_to_date=True, now=now)) == (
        at("2024-02-01"),
        at("2024-03-01"),
    )
    assert bounds(spark, resolve_range(now=now)) == (at("2024-02-29"), at("2024-03-01"))
    assert bounds(spark, resolve_range(days_ago=None, now=now)) == (
        at("2024-02-29"),
        at("2024-03-01"),
    )
    assert bounds(spark, resolve_range(end="2020-01-01", days_ago=3, now=now)) == (
        at("2024-02-27"),
        at("2024-02-28"),
    )
    with pytest.raises(ValueError):
        resolve_range("2024-01-05")
    with pytest.raises(ValueError):
        resolve_range()


@pytest.mark.parametrize(
    "now, first, last",
    [
        ("2024-03-15 09:00:00", date(2024, 3, 1), date(2024, 3, 14)),
        ("2024-03-02", date(2024, 3, 1), date(2024, 3, 1)),
        ("2024-03-01 23:59:00", date(2024, 2, 1), date(2024, 2, 29)),
        ("2024-01-01", date(2023, 12, 1), date(2023, 12, 31)),
    ],
)
def test_problem_range_without_dates(spark, now, first, last):
    days = csc_range(now=now)
    assert value(spark, days.first) == first
    assert value(spark, days.last) == last


def test_problem_range_with_dates(spark):
    days = csc_range("2024-01-05 13:00:00", datetime(2024, 1, 6, 14))
    assert value(spark, days.first) == date(2024, 1, 5)
    assert value(spark, days.last) == date(2024, 1, 6)
    assert bounds(spark, days.reports) == (at("2024-01-05"), at("2024-01-07"))
    assert not days.reports.closed
    assert days.calls.closed
    for given in [("2024-01-05", None), (None, "2024-01-05"), (None, None)]:
        with pytest.raises(ValueError):
            csc_range(*given)


def test_a_moment_with_a_zone_is_refused():
    with pytest.raises(ValueError, match="zone"):
        dates.as_time(datetime(2024, 1, 7, 23, 30, tzinfo=timezone(timedelta(hours=-5))))
