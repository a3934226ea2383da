"""Steps of the daily operator-performance report."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringledger.functions.dates import (
    When,
    as_time,
    hours_between,
    midnight,
    months_between,
    seconds_between,
)
from ringledger.functions.numbering import number_rows
from ringledger.functions.text import BYTES, as_key
from ringledger.functions.timeflags import (
    ACTIVITY,
    BUCKETS,
    CONVO,
    LABOR,
    LONG_MINUTES,
    MINUTES,
    SESSION,
    bucket_sums,
    in_units,
    measure_name,
    or_zero,
    time_flags,
)
from ringledger.operators.windows import Window

# Rows of the report are identified by centre, operator and day. Every per-day
# aggregate below groups by these columns with these types, so all of them leave the
# shuffle partitioned alike and their joins need no further one.
KEYS = ["CallCenterCode", "OperatorID", "Handoff_Date"]

# The session minutes and the entry types each one counts.
ENTRY_MINUTES = {"BreakMins": "2", "TeamedMins": "6", "AvailableMins": "1, 6"}

# The report's buckets, in its column order.
REPORT_BUCKETS = [
    "AllDays_12to12",
    "MtoF_6to12",
    "MtoF_12to6",
    "Sat_12to12",
    "Sun_12to12",
    "Sat_6to6",
    "Sun_6to6",
    "MtoF_NonCore",
    "MtoF_6to6",
    "MtoF_NonCore_SatSun",
]
REPORT_MEASURES = [LABOR, CONVO, SESSION, ACTIVITY]

# Ratio columns and the bucket each one compares. Weekday 6-to-6 has none.
RATIOS = {
    "AllDays_12to12_ConvoPctVSEnt": "AllDays_12to12",
    "MtoF_6ato12_ConvoPctVSEnt": "MtoF_6to12",
    "MtoF_12to6_ConvoPctVSEnt": "MtoF_12to6",
    "Sat_12to12_ConvoPctVSEnt": "Sat_12to12",
    "Sat_6to6_ConvoPctVSEnt": "Sat_6to6",
    "Sun_12to12_ConvoPctVSEnt": "Sun_12to12",
    "Sun_6to6_ConvoPctVSEnt": "Sun_6to6",
    "MtoF_NonCore_ConvoPctVSEnt": "MtoF_NonCore",
    "MtoF_NonCore_SatSun_ConvoPctVSEnt": "MtoF_NonCore_SatSun",
}
RATIO = "decimal(12,4)"

ALL_LABOR = measure_name("AllDays_12to12", LABOR)

# Decimal literals.
MINUTE, HOUR, YEAR = "60.0", "3600.0", "8766.0"


def session_minutes(sessions: DataFrame, report: Window) -> DataFrame:
    """Break, teamed and available minutes per centre, operator and day.

    The day on which the range ends is included: calls filed under that day by an
    adjusted date still find their session.
    """
    return (
        _entries(sessions, report)
        .groupBy(*KEYS)
        .agg(*_entry_sums())
        .selectExpr(*KEYS, *_entry_minutes())
    )


def session_days(sessions: DataFrame, report: Window) -> DataFrame:
    """``session_minutes`` and ``login_minutes`` in one pass over the sessions.

    Login time counts on the day it is filed under, so an entry whose date carries a
    time of day has none; it would not join a day either. Other than session time, it
    ends with the range.
    """
    worked = "if(Date = Handoff_Date and in_range, LoginTime + TeamingTime - BreakTime, null)"
    return (
        _entries(sessions, report)
        .groupBy(*KEYS)
        .agg(*_entry_sums(), *bucket_sums(worked, ACTIVITY))
        .selectExpr(*KEYS, *_entry_minutes(), *in_units(ACTIVITY, MINUTE))
    )


def bucket_calls(
    calls: DataFrame,
    report: Window,
    time_col: str = "Handoff_time",
    date_col: str = "Handoff_Date",
) -> DataFrame:
    """Conversation and session minutes by time bucket.

    ``time_col`` and ``date_col`` name the hand-off columns, for tables that carry
    adjusted ones.
    """
    return (
        calls.where(report.covers(F.col(time_col)) & F.col("OperatorID").isNotNull())
        .groupBy(*_keys(calls, "LocationCode", "OperatorID", midnight(F.col(date_col))))
        .agg(*bucket_sums("ConvoTime", CONVO), *bucket_sums("SessionTime", SESSION))
        .selectExpr(*KEYS, *in_units(CONVO, MINUTE), *in_units(SESSION, MINUTE))
    )


# Sums of single days, which add up to those of any range of whole days. Each has the day
# that its rows were selected by, in ``run_day``; a call's may differ from the day it is
# filed under.
RUN_DAY = "run_day"


def call_sums(
    calls: DataFrame,
    report: Window,
    time_col: str = "Handoff_time",
    date_col: str = "Handoff_Date",
) -> DataFrame:
    """Seconds behind ``bucket_calls``, per day of hand-off."""
    day = midnight(F.col(time_col)).alias(RUN_DAY)
    return (
        calls.where(report.covers(F.col(time_col)) & F.col("OperatorID").isNotNull())
        .groupBy(*_keys(calls, "LocationCode", "OperatorID", midnight(F.col(date_col))), day)
        .agg(*bucket_sums("ConvoTime", CONVO), *bucket_sums("SessionTime", SESSION))
    )


def session_sums(sessions: DataFrame, report: Window) -> DataFrame:
    """Seconds behind ``session_days``, per day, those filed at midnight apart.

    A range counts the entries filed at the midnight that it ends with, but not their login
    time, so it needs them by themselves.
    """
    worked = "if(Date = Handoff_Date, LoginTime + TeamingTime - BreakTime, null)"
    entries = _entries(sessions.where(report.covers(F.col("Date"))), report)
    at_midnight = F.expr("Date = Handoff_Date").alias("at_midnight")
    return (
        entries.groupBy(*KEYS, F.col("Handoff_Date").alias(RUN_DAY), at_midnight)
        .agg(*_entry_sums(), *bucket_sums(worked, ACTIVITY))
    )


def labor_sums(labor: DataFrame, report: Window) -> DataFrame:
    """Seconds behind ``labor_hours``, per day and name."""
    return _labor_by_name(labor, report, midnight(F.col("ShiftDate")).alias(RUN_DAY))


def bucket_calls_of(sums: DataFrame) -> DataFrame:
    """``bucket_calls`` from ``call_sums``."""
    return (
        sums.groupBy(*KEYS)
        .agg(*_added(CONVO), *_added(SESSION))
        .selectExpr(*KEYS, *in_units(CONVO, MINUTE), *in_units(SESSION, MINUTE))
    )


def session_days_of(sums: DataFrame, report: Window) -> DataFrame:
    """``session_days`` from ``session_sums`` of the range and the day it ends on."""
    inside = F.col(RUN_DAY) < report.stop
    within = sums.withColumns(
        {name: F.when(inside, F.col(name)) for name in _measures_of(ACTIVITY)}
    )
    counted = inside | ((F.col(RUN_DAY) == report.stop) & F.col("at_midnight"))
    return (
        within.where((F.col(RUN_DAY) >= report.start) & counted)
        .groupBy(*KEYS)
        .agg(*(F.sum(name).alias(name) for name in ENTRY_MINUTES), *_added(ACTIVITY))
        .selectExpr(*KEYS, *_entry_minutes(), *in_units(ACTIVITY, MINUTE))
    )


def labor_hours_of(sums: DataFrame) -> DataFrame:
    """``labor_hours`` from ``labor_sums``."""
    return (
        sums.groupBy(*KEYS, "OperatorName").agg(*_added(LABOR))
        .groupBy(*KEYS)
        .agg(F.min("OperatorName").alias("OperatorName"), *_added(LABOR))
        .selectExpr(*KEYS, "OperatorName", *in_units(LABOR, HOUR))
    )


def _measures_of(measure: str) -> list[str]:
    return [measure_name(bucket, measure) for bucket in BUCKETS]


def _added(measure: str) -> list[Column]:
    return [F.sum(name).alias(name) for name in _measures_of(measure)]


def call_data(buckets: DataFrame, sessions: DataFrame) -> DataFrame:
    """Call minutes of the operator-days that also have a session."""
    return buckets.join(sessions, KEYS)


def labor_hours(labor: DataFrame, report: Window) -> DataFrame:
    """Scheduled hours of benchmark tasks by time bucket, with the operator's name.

    Spark aggregates text minima by sorting. Grouping by name first keeps the large
    aggregation a hash aggregation, and leaves only a row per name to sort.
    """
    return (
        _labor_by_name(labor, report)
        .groupBy(*KEYS)
        .agg(F.min("OperatorName").alias("OperatorName"), *_added(LABOR))
        .selectExpr(*KEYS, "OperatorName", *in_units(LABOR, HOUR))
    )


def _labor_by_name(labor: DataFrame, report: Window, *further: Column) -> DataFrame:
    keys = _keys(labor, "CallCenterCode", "OperatorID", as_time(F.col("ShiftDate")))
    name = F.collate("OperatorName", BYTES).alias("OperatorName")
    return (
        labor.where(report.covers(F.col("ShiftDate")) & (F.col("IsBenchmarkTask") == 1))
        .groupBy(*keys, name, *further)
        .agg(*bucket_sums("LaborTime_Secs", LABOR))
    )


def login_minutes(activity: DataFrame, report: Window) -> DataFrame:
    """Login plus teaming less break minutes by time bucket.

    An entry with any of the three unknown is skipped.
    """
    worked = "LoginTime_Secs + TeamingTime_Secs - BreakTime_Secs"
    return (
        activity.where(report.covers(F.col("Activity_Date")))
        .groupBy(*_keys(activity, "CallCenterCode", "OperatorID", as_time(F.col("Activity_Date"))))
        .agg(*bucket_sums(worked, ACTIVITY))
        .selectExpr(*KEYS, *in_units(ACTIVITY, MINUTE))
    )


def with_login_minutes(call_days: DataFrame, login: DataFrame) -> DataFrame:
    return call_days.join(login, KEYS, "left")


def with_labor_hours(call_days: DataFrame, labor: DataFrame) -> DataFrame:
    return call_days.join(labor, KEYS, "left")


def employee_data(call_days: DataFrame, employees: DataFrame, end: When) -> DataFrame:
    """Named employees among the operators, numbered by name, with their tenure."""
    end = as_time(end)
    hired = as_time(F.col("HireDate"))
    # Six decimals in the dividend give the quotient twelve before it is rounded.
    years = hours_between(hired, end).cast("decimal(20,6)") / F.lit(Decimal(YEAR))
    operators = call_days.select("OperatorID").distinct()
    staff = (
        employees.where(F.col("EmployeeName").isNotNull())
        .join(operators, F.col("ExternalID") == F.col("OperatorID"))
        .select(
            F.collate("EmployeeName", BYTES).alias("Employee_Name"),
            "OperatorID",
            F.col("ADP_ID").cast("int").alias("ADP_ID"),
            as_key(employees, "DefaultLocation").alias("DefaultLocation"),
            "StaffType",
            F.col("Language").alias("LanguageSkill"),
            hired.alias("HireDate"),
            months_between(hired, end).cast("int").alias("MnthsTenure"),
            years.cast(MINUTES).alias("YearTenure"),
            as_time(F.col("TermDate")).alias("TermDate"),
            "Active",
        )
        .distinct()
    )
    # All columns break ties in the name, so the order is total.
    return number_rows(staff, staff.columns, "Emp_RowNum")


def operator_day(activity: DataFrame, staff: DataFrame, report: Window) -> DataFrame:
    """The 56-column operator-day table.

    An operator with several employee rows gets a row for each.
    """
    joined = activity.join(staff, "OperatorID", "left")
    return joined.select(
        report.start.alias("StartDate"),
        midnight(report.stop).alias("EndDate"),
        *map(
            F.expr,
            [
                "Handoff_Date as rptDate",
                "coalesce(DefaultLocation, CallCenterCode) as HomeLocation",
                "CallCenterCode",
                "OperatorID",
                "ADP_ID",
                "Emp_RowNum",
                "coalesce(Employee_Name, OperatorName) as employee_name",
                "StaffType",
                "LanguageSkill",
                "if(Active = 'False', null, HireDate) as HireDate",
                "if(Active = 'False', 0, MnthsTenure) as MnthsTenure",
                *ENTRY_MINUTES,
                *[_measure(b, m) for b in REPORT_BUCKETS for m in REPORT_MEASURES],
            ],
        ),
    )


def enterprise_ratio(days: DataFrame, report: Window) -> DataFrame:
    """Conversation time as a share of labour time, over all operators, per day."""
    return (
        with_labor(days, report)
        .groupBy("rptDate")
        .agg(*[F.expr(f"{_daily_ratio(b)} as {name}") for name, b in RATIOS.items()])
    )


def operator_performance(days: DataFrame, daily: DataFrame, report: Window) -> DataFrame:
    """Operator-days with labour, beside the day's ratios.

    A ratio is 0 where the row itself has no labour in that bucket.
    """
    shown = [
        f"cast(if({measure_name(bucket, LABOR)} = 0, 0, {name}) as {RATIO}) as {name}"
        for name, bucket in RATIOS.items()
    ]
    return with_labor(days, report).join(daily, "rptDate").selectExpr(*days.columns, *shown)


def with_labor(days: DataFrame, report: Window) -> DataFrame:
    in_range = F.col("rptDate").between(report.start, report.stop)
    return days.where(in_range & (F.col(ALL_LABOR) > 0))


def _entries(sessions: DataFrame, report: Window) -> DataFrame:
    """Session entries of the range with their day, length in seconds and time flags."""
    columns = ["Date", "EntryType", "LoginTime", "TeamingTime", "BreakTime"]
    return sessions.where(F.col("Date").between(report.start, report.stop)).select(
        *_keys(sessions, "CallCenterCode", "OperatorID", midnight(F.col("Date"))),
        seconds_between(F.col("AdjStartTime"), F.col("AdjEndTime")).alias("seconds"),
        report.covers(F.col("Date")).alias("in_range"),
        *map(F.expr, [*columns, *time_flags("AdjStartTime")]),
    )


def _entry_sums() -> list[Column]:
    return [
        F.expr(f"sum(if(EntryType in ({types}), seconds, 0)) as {name}")
        for name, types in ENTRY_MINUTES.items()
    ]


def _entry_minutes() -> list[str]:
    return [f"cast({name} / {MINUTE} as {MINUTES}) as {name}" for name in ENTRY_MINUTES]


def _keys(df: DataFrame, center: str, operator: str, day: Column) -> list[Column]:
    columns = [as_key(df, center), F.col(operator), day]
    return [column.alias(key) for column, key in zip(columns, KEYS)]


def _measure(bucket: str, measure: str) -> str:
    """A bucket measure, 0 where unknown. The off-hours bucket adds up three others."""
    name = measure_name(bucket, measure)
    if bucket == "MtoF_NonCore_SatSun":
        parts = ["MtoF_NonCore", "Sat_12to12", "Sun_12to12"]
        total = " + ".join(or_zero(measure_name(part, measure)) for part in parts)
        return f"cast({total} as {LONG_MINUTES}) as {name}"
    long = bucket == "MtoF_6to6" and measure in (LABOR, ACTIVITY)
    return f"cast({or_zero(name)} as {LONG_MINUTES if long else MINUTES}) as {name}"


def _daily_ratio(bucket: str) -> str:
    labor = f"sum({measure_name(bucket, LABOR)})"
    convo = f"sum({measure_name(bucket, CONVO)})"
    share = f"{convo} / nullif({labor} * {MINUTE}, 0)"
    return f"cast(if({labor} = 0, 0, {share}) as {RATIO})"
