"""Daily operator-performance report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ringledger.functions.dates import midnight
from ringledger.functions.materialize import materialize
from ringledger.operators import performance as steps
from ringledger.operators.views import labor_time, split30_all
from ringledger.operators.windows import Window
from ringledger.sources.days import DAY, read_days, replace_days


@dataclass(frozen=True)
class PerformanceSources:
    """Source tables of the report.

    Calls count at the time and on the day of the two hand-off columns. Call tables that
    carry adjusted ones can name those instead.
    """

    vrs: DataFrame
    vri: DataFrame
    relay: DataFrame
    sessions: DataFrame
    schedule: DataFrame
    employees: DataFrame
    handoff_time: str = "Handoff_time"
    handoff_date: str = "Handoff_Date"


def operator_days(sources: PerformanceSources, report: Window) -> DataFrame:
    """The operator-day table, from the sources.

    The employee step and the report both need the operator-days, and the report
    needs them twice. They are written once, so each source is scanned once. What is
    written has a row per operator and day, far below the size of the sources.
    """
    handoff = (sources.handoff_time, sources.handoff_date)
    further = tuple(c for c in handoff if c not in ("Handoff_time", "Handoff_Date"))
    calls = split30_all(sources.vrs, sources.vri, sources.relay, further)
    # One pass gives session and login minutes, and one join brings in both.
    call_days = steps.call_data(
        steps.bucket_calls(calls, report, *handoff),
        steps.session_days(sources.sessions, report),
    )
    labor = steps.labor_hours(labor_time(sources.schedule), report)
    return _days(steps.with_labor_hours(call_days, labor), sources.employees, report)


def _days(activity: DataFrame, employees: DataFrame, report: Window) -> DataFrame:
    activity = materialize(activity, "operator-activity")
    staff = steps.employee_data(activity, employees, report.stop)
    return steps.operator_day(activity, staff, report)


def performance_report(sources: PerformanceSources, report: Window) -> DataFrame:
    """Operator-days with labour, with the day's enterprise ratios, in report order."""
    return _report(operator_days(sources, report), report)


def _report(days: DataFrame, report: Window) -> DataFrame:
    daily = steps.enterprise_ratio(days, report)
    performance = steps.operator_performance(days, daily, report)
    # Operator and employee row let the sort split a centre's day.
    return performance.orderBy("CallCenterCode", "rptDate", "OperatorID", "Emp_RowNum")


@dataclass(frozen=True)
class DayStore:
    """Sums of operator-days, stored by day under ``folder``.

    A run for the month to date adds up stored days and reads the sources for the new ones
    only. A day that is refreshed again replaces what was stored for it.
    """

    folder: str

    def refresh(self, sources: PerformanceSources, days: Window) -> None:
        """Compute the sums of the days that ``days`` covers, and store them.

        Only rows of these days are read from the sources, by a filter with constant
        bounds. A range must cover whole days.
        """
        self._whole_days(sources.vrs.sparkSession, days)
        handoff = (sources.handoff_time, sources.handoff_date)
        further = tuple(c for c in handoff if c not in ("Handoff_time", "Handoff_Date"))
        calls = split30_all(sources.vrs, sources.vri, sources.relay, further)
        sums = {
            "calls": steps.call_sums(calls, days, *handoff),
            "sessions": steps.session_sums(sources.sessions, days),
            "labor": steps.labor_sums(labor_time(sources.schedule), days),
        }
        for name, df in sums.items():
            replace_days(materialize(df, f"{name}-sums"), f"{self.folder}/{name}", steps.RUN_DAY, days)

    def report(self, employees: DataFrame, report: Window) -> DataFrame:
        """``performance_report`` from the stored days of a range, all of them refreshed."""
        return _report(self.days(employees, report), report)

    def days(self, employees: DataFrame, report: Window) -> DataFrame:
        """``operator_days`` from the stored days of a range.

        What the midnight that ends the range has of sessions counts if its day is stored.
        """
        spark = employees.sparkSession
        self._whole_days(spark, report)

        def stored(name: str, window: Window) -> DataFrame:
            # The columns of a stored table are its own; the day is only its folder.
            table = spark.read.parquet(f"{self.folder}/{name}").drop(DAY)
            return read_days(spark, f"{self.folder}/{name}", table.schema, window)

        # The midnight that the range ends with belongs to its sessions.
        closed = Window(report.start, report.stop, closed=True)
        call_days = steps.call_data(
            steps.bucket_calls_of(stored("calls", report)),
            steps.session_days_of(stored("sessions", closed), report),
        )
        labor = steps.labor_hours_of(stored("labor", report))
        return _days(steps.with_labor_hours(call_days, labor), employees, report)

    @staticmethod
    def _whole_days(spark: SparkSession, days: Window) -> None:
        ends = [days.start, days.stop]
        whole = [midnight(end) == end.cast("timestamp_ntz") for end in ends]
        if days.closed or not all(spark.range(1).select(*whole).first()):
            raise ValueError("days are stored whole: give a range from midnight to midnight")
