"""

Every query reads the given test tables whole, in the shape of the report's source
tables (``FIXTURES.md``). Decimals leave here as doubles, so that both engines return
the same type.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable
from dataclasses import replace
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from oracle.queries import oracle_sql as _oracle_sql  # noqa: E402
from ringledger.functions import dates, text  # noqa: E402
from ringledger.functions.materialize import materialize, shared_folder  # noqa: E402
from ringledger.operators import performance, problems, retention, shifts, views  # noqa: E402
from ringledger.operators.windows import (  # noqa: E402
    Window,
    csc_range,
    month_windows,
    resolve_range,
)
from ringledger.plans import performance as performance_plan  # noqa: E402
from ringledger.plans import problems as problems_plan  # noqa: E402
from ringledger.plans import retention as retention_plan  # noqa: E402
from ringledger.sources import buckets, days, inserts, schemas, standins  # noqa: E402
from ringledger.sources.tables import read_source  # noqa: E402

# The training-text operators are an optional part: without their folder, all else works.
try:
    from ringledger.llm import queries as llm
except ImportError:
    llm = None

SMOKE_DIR = "/root/testdata/sf0.001"

# Report parameters that suit the test data.
RETENTION_END = "1998-05-31"
PERFORMANCE_DAYS = ("2024-01-08", "2024-01-21")
PROBLEM_DAYS = ("2024-01-05", "2024-01-24")
COMPANY = "Company B"

Query = Callable[[SparkSession, str], DataFrame]


def entry(spark: SparkSession) -> DataFrame:
    """The monthly retention report on the smallest test data."""
    return css_report(spark, SMOKE_DIR)


def queries() -> dict[str, Query]:
    """All registered queries."""
    return report_queries() | (llm.queries() if llm else {})


def oracle_sql() -> dict[str, str]:
    """The same queries as SQL for DuckDB, where SQL can express them."""
    return report_sql() | (llm.oracle_sql() if llm else {})


def report_queries() -> dict[str, Query]:
    """One query per operator and report of the call centre."""
    named = [
        scan_call_detail,
        read_source_orders,
        date_functions,
        month_windows_query,
        resolve_range_query,
        csc_range_query,
        user_score,
        terp_score,
        outbound_calls,
        agent_score,
        css_report,
        css_report_closed_dates,
        activity_time,
        labor_time,
        split30_all,
        session_minutes,
        bucket_calls,
        call_data,
        labor_hours,
        login_minutes,
        operator_activity,
        employee_data,
        operator_day,
        enterprise_ratio,
        operator_performance,
        operator_performance_adjusted,
        company_locations,
        company_location_list,
        caption_slice,
        csc_session_match,
        csc_direct_match,
        csc_report,
        csc_report_all_companies,
        read_source_catalog,
        activity_in_shift,
        half_hour_calls,
        split30_inserted,
        operator_performance_any_case,
        operator_performance_sink,
        operator_performance_stored,
        csc_report_any_case,
        csc_session_match_bucketed,
        caption_slice_by_day,
    ]
    return {query.__name__.removesuffix("_query"): _as_doubles(query) for query in named}


def report_sql() -> dict[str, str]:
    return _oracle_sql()


def _as_doubles(query: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        df = query(spark, folder)
        casts = [
            f"cast({name} as double) as {name}" if kind.startswith("decimal") else name
            for name, kind in df.dtypes
        ]
        return df.selectExpr(*casts)

    return run


# Dates and ranges, applied to every row of a table.


def date_functions(spark: SparkSession, folder: str) -> DataFrame:
    ts = F.col("ts")
    since = "2023-11-30 23:59:59.5"
    return standins.test_table(spark, folder, "events").select(
        "event_id",
        dates.add_months(ts, 1).alias("next_month"),
        dates.add_days(ts, 1).alias("next_day"),
        dates.month_start(ts).alias("month_first"),
        dates.month_start(ts, 1).alias("prior_first"),
        dates.month_last_day(ts, 1).alias("prior_last"),
        dates.midnight(ts).alias("today"),
        dates.add_days(dates.midnight(ts), -1).alias("yesterday"),
        dates.seconds_between(since, ts).alias("seconds"),
        dates.hours_between(since, ts).cast("bigint").alias("hours"),
        dates.months_between(since, ts).cast("bigint").alias("months"),
        F.hour(ts).alias("hour_of_day"),
        F.dayofweek(ts).alias("day_of_week"),
        F.dayofmonth(ts).alias("day_of_month"),
        F.month(ts).alias("month_of_year"),
    )


def month_windows_query(spark: SparkSession, folder: str) -> DataFrame:
    windows = month_windows(F.col("o_orderdate"))
    closed = month_windows(F.col("o_orderdate"), closed_dates=True)
    return standins.test_table(spark, folder, "orders").select(
        "o_orderkey",
        windows.overall.start.alias("overall_start"),
        windows.overall.stop.alias("overall_stop"),
        windows.current.start.alias("current_start"),
        windows.current.stop.alias("current_stop"),
        windows.prior.start.alias("prior_start"),
        windows.prior.stop.alias("prior_stop"),
        closed.current.stop.alias("current_last"),
        closed.prior.stop.alias("prior_last"),
        windows.report_start.alias("report_start"),
        windows.report_end.alias("report_end"),
    )


def resolve_range_query(spark: SparkSession, folder: str) -> DataFrame:
    now = F.col("ts")
    to_date = resolve_range(month_to_date=True, now=now)
    ago = resolve_range(days_ago=(F.col("event_id") % 10).cast("int"), now=now)
    given = resolve_range(now, now)
    return standins.test_table(spark, folder, "events").select(
        "event_id",
        to_date.start.alias("to_date_start"),
        to_date.stop.alias("to_date_stop"),
        ago.start.alias("ago_start"),
        ago.stop.alias("ago_stop"),
        given.start.alias("given_start"),
        given.stop.alias("given_stop"),
    )


def csc_range_query(spark: SparkSession, folder: str) -> DataFrame:
    days = csc_range(now=F.col("o_orderdate"))
    return standins.test_table(spark, folder, "orders").select(
        "o_orderkey", days.first.alias("first_day"), days.last.alias("last_day")
    )


# Monthly retention.


def scan_call_detail(spark: SparkSession, folder: str) -> DataFrame:
    return standins.call_detail(spark, folder)


def read_source_orders(spark: SparkSession, folder: str) -> DataFrame:
    """A source read by path, with a number and a text in wider or equal types."""
    columns = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string"}
    return read_source(spark, f"{folder}/orders.parquet", columns)


def user_score(spark: SparkSession, folder: str) -> DataFrame:
    calls = standins.call_detail(spark, folder)
    return retention.user_score(calls, month_windows(RETENTION_END))


def terp_score(spark: SparkSession, folder: str) -> DataFrame:
    calls, windows = standins.call_detail(spark, folder), month_windows(RETENTION_END)
    return retention.terp_score(calls, retention.user_score(calls, windows), windows)


def outbound_calls(spark: SparkSession, folder: str) -> DataFrame:
    calls = standins.call_detail(spark, folder)
    return retention.outbound_calls(calls, month_windows(RETENTION_END).current)


def agent_score(spark: SparkSession, folder: str) -> DataFrame:
    return retention.agent_score(terp_score(spark, folder), outbound_calls(spark, folder))


def css_report(spark: SparkSession, folder: str) -> DataFrame:
    return retention_plan.css_report(standins.call_detail(spark, folder), RETENTION_END)


def css_report_closed_dates(spark: SparkSession, folder: str) -> DataFrame:
    windows = month_windows(RETENTION_END, closed_dates=True)
    calls = standins.call_detail(spark, folder)
    return retention_plan.css_report(calls, RETENTION_END, windows)


# Daily performance.


def _calls(spark: SparkSession, folder: str) -> DataFrame:
    return views.split30_all(
        standins.calls_vrs(spark, folder),
        standins.calls_vri(spark, folder),
        standins.calls_relay(spark, folder),
    )


def _performance_sources(
    spark: SparkSession, folder: str
) -> performance_plan.PerformanceSources:
    return performance_plan.PerformanceSources(
        vrs=standins.calls_vrs(spark, folder),
        vri=standins.calls_vri(spark, folder),
        relay=standins.calls_relay(spark, folder),
        sessions=standins.session_history(spark, folder),
        schedule=standins.schedule(spark, folder),
        employees=standins.employees(spark, folder),
    )


def activity_time(spark: SparkSession, folder: str) -> DataFrame:
    return views.activity_time(standins.session_history(spark, folder))


def labor_time(spark: SparkSession, folder: str) -> DataFrame:
    return views.labor_time(standins.schedule(spark, folder))


def split30_all(spark: SparkSession, folder: str) -> DataFrame:
    return _calls(spark, folder)


def session_minutes(spark: SparkSession, folder: str) -> DataFrame:
    sessions = standins.session_history(spark, folder)
    return performance.session_minutes(sessions, resolve_range(*PERFORMANCE_DAYS))


def bucket_calls(spark: SparkSession, folder: str) -> DataFrame:
    return performance.bucket_calls(_calls(spark, folder), resolve_range(*PERFORMANCE_DAYS))


def call_data(spark: SparkSession, folder: str) -> DataFrame:
    return performance.call_data(bucket_calls(spark, folder), session_minutes(spark, folder))


def labor_hours(spark: SparkSession, folder: str) -> DataFrame:
    return performance.labor_hours(labor_time(spark, folder), resolve_range(*PERFORMANCE_DAYS))


def login_minutes(spark: SparkSession, folder: str) -> DataFrame:
    activity = activity_time(spark, folder)
    return performance.login_minutes(activity, resolve_range(*PERFORMANCE_DAYS))


def operator_activity(spark: SparkSession, folder: str) -> DataFrame:
    """Operator-days with login and labour, by the separate steps."""
    logged_in = performance.with_login_minutes(
        call_data(spark, folder), login_minutes(spark, folder)
    )
    return performance.with_labor_hours(logged_in, labor_hours(spark, folder))


def employee_data(spark: SparkSession, folder: str) -> DataFrame:
    return performance.employee_data(
        call_data(spark, folder),
        standins.employees(spark, folder),
        resolve_range(*PERFORMANCE_DAYS).stop,
    )


def operator_day(spark: SparkSession, folder: str) -> DataFrame:
    return performance_plan.operator_days(
        _performance_sources(spark, folder), resolve_range(*PERFORMANCE_DAYS)
    )


def enterprise_ratio(spark: SparkSession, folder: str) -> DataFrame:
    rows = operator_day(spark, folder)
    return performance.enterprise_ratio(rows, resolve_range(*PERFORMANCE_DAYS))


def operator_performance(spark: SparkSession, folder: str) -> DataFrame:
    return performance_plan.performance_report(
        _performance_sources(spark, folder), resolve_range(*PERFORMANCE_DAYS)
    )


def operator_performance_adjusted(spark: SparkSession, folder: str) -> DataFrame:
    """The report by adjusted hand-off columns, here five hours after the hand-off."""
    sources = _performance_sources(spark, folder)
    later = F.expr("Handoff_time + interval 5 hours")

    def adjusted(calls: DataFrame) -> DataFrame:
        return calls.withColumns({"Handoff_time_adj": later, "Handoff_Date_adj": later.cast("date")})

    sources = replace(
        sources,
        vrs=adjusted(sources.vrs),
        vri=adjusted(sources.vri),
        relay=adjusted(sources.relay),
        handoff_time="Handoff_time_adj",
        handoff_date="Handoff_Date_adj",
    )
    return performance_plan.performance_report(sources, resolve_range(*PERFORMANCE_DAYS))


# Problem reports.


def _problem_sources(spark: SparkSession, folder: str) -> problems_plan.ProblemSources:
    return problems_plan.ProblemSources(
        reports=standins.problem_reports(spark, folder),
        categories=standins.problem_categories(spark, folder),
        calls=standins.caption_calls(spark, folder),
        xref=standins.caption_xref(spark, folder),
        intervals=standins.caption_intervals(spark, folder),
    )


def company_locations(spark: SparkSession, folder: str) -> DataFrame:
    return problems.company_locations(standins.caption_intervals(spark, folder))


def company_location_list(spark: SparkSession, folder: str) -> DataFrame:
    return problems.company_location_list(company_locations(spark, folder))


def caption_slice(spark: SparkSession, folder: str) -> DataFrame:
    return problems.caption_slice(
        standins.caption_calls(spark, folder), csc_range(*PROBLEM_DAYS)
    )


def csc_session_match(spark: SparkSession, folder: str) -> DataFrame:
    sources, window = _problem_sources(spark, folder), csc_range(*PROBLEM_DAYS)
    reported = problems.reported_problems(sources.reports, sources.categories, window)
    calls = problems_plan.candidate_calls(sources, window, COMPANY)
    return problems.csc_session_match(reported, sources.xref, calls, window)


def csc_direct_match(spark: SparkSession, folder: str) -> DataFrame:
    sources, window = _problem_sources(spark, folder), csc_range(*PROBLEM_DAYS)
    reported = problems.reported_problems(sources.reports, sources.categories, window)
    calls = problems_plan.candidate_calls(sources, window, COMPANY)
    return problems.csc_direct_match(reported, calls, window)


def csc_report(spark: SparkSession, folder: str) -> DataFrame:
    sources = _problem_sources(spark, folder)
    return problems_plan.csc_report(sources, csc_range(*PROBLEM_DAYS), COMPANY)


def csc_report_all_companies(spark: SparkSession, folder: str) -> DataFrame:
    sources = _problem_sources(spark, folder)
    return problems_plan.csc_report(sources, csc_range(*PROBLEM_DAYS))


# Sources as they may be stored, and results as they may be kept.


def read_source_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """A source read by a name of three parts."""
    name = _new_name("orders")
    spark.sql(f"create table spark_catalog.default.{name} using parquet location '{folder}/orders.parquet'")
    columns = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string"}
    return read_source(spark, f"spark_catalog.default.{name}", columns)


def activity_in_shift(spark: SparkSession, folder: str) -> DataFrame:
    return shifts.covering_shifts(activity_time(spark, folder), labor_time(spark, folder))


def half_hour_calls(spark: SparkSession, folder: str) -> DataFrame:
    spans = {"SessionTime": ("SessionStart", "SessionEnd"), "ConvoTime": ("ConvoStart", "ConvoEnd")}
    return shifts.split_half_hours(standins.raw_calls(spark, folder), spans).select(
        "CallID", "Interval_Time", "First_Interval", "Last_Interval", *spans
    )


def split30_inserted(spark: SparkSession, folder: str) -> DataFrame:
    """The calls put by position into a table declared in the view's column order."""
    kinds = {**schemas.RELAY_CALLS, "CallData_Type": "varchar(10)", "Handoff_Date": "date",
             "UserID_Caller_TDN": "varchar(64)"}
    declared = {name: kinds[name] for name in views.CALL_COLUMNS}
    path = _new_path(spark, "calls")
    inserts.insert(_calls(spark, folder), path, declared)
    return spark.read.parquet(path)


def _any_case(df: DataFrame, columns: list[str], lowered: str) -> DataFrame:
    """Codes in lower case in the rows where ``lowered`` holds, and case ignored in all."""
    mixed = {c: F.when(F.expr(lowered), F.lower(c)).otherwise(F.col(c)) for c in columns}
    return text.collated(df.withColumns(mixed))


def _as_lower(df: DataFrame, columns: list[str]) -> DataFrame:
    """One spelling of the codes, compared byte by byte."""
    return text.plain(df).withColumns({c: F.lower(c) for c in columns})


def operator_performance_any_case(spark: SparkSession, folder: str) -> DataFrame:
    """The report from sources that spell codes and tasks in either case."""
    sources = _performance_sources(spark, folder)
    third = "cast(right(CallID, 1) as int) % 3 = 0"
    sources = replace(
        sources,
        vrs=_any_case(sources.vrs, ["LocationCode"], third),
        vri=_any_case(sources.vri, ["LocationCode"], third),
        relay=_any_case(sources.relay, ["LocationCode"], third),
        sessions=_any_case(sources.sessions, ["CallCenterCode"], "EntryType % 2 = 0"),
        schedule=_any_case(sources.schedule, ["Station_Name", "TaskName"], "minute(HlfHrStart) = 0"),
        employees=_any_case(sources.employees, ["Active", "DefaultLocation"], "ExternalID % 2 = 0"),
    )
    report = performance_plan.performance_report(sources, resolve_range(*PERFORMANCE_DAYS))
    return _as_lower(report, ["HomeLocation", "CallCenterCode"])


def csc_report_any_case(spark: SparkSession, folder: str) -> DataFrame:
    """The report from sources that spell codes and sessions in either case."""
    sources = _problem_sources(spark, folder)
    third = "cast(right(CallID, 1) as int) % 3 = 0"
    sources = replace(
        sources,
        reports=_any_case(sources.reports, ["SessionID", "ErrorCode"], "ProblemReportID % 2 = 0"),
        categories=text.collated(sources.categories),
        calls=_any_case(sources.calls, ["csOprSessionID", "locationcode"], third),
        xref=_any_case(sources.xref, ["SessionID"], third),
        intervals=_any_case(sources.intervals, ["companyname", "locationcode"], "locationcode > 'C2'"),
    )
    report = problems_plan.csc_report(sources, csc_range(*PROBLEM_DAYS), COMPANY.upper())
    return _as_lower(report, ["csOprSessionID", "SessionID", "locationcode", "ErrorCode"])


def operator_performance_sink(spark: SparkSession, folder: str) -> DataFrame:
    """The report stored by its day, once for all days and once more for the later ones."""
    path, report = _new_path(spark, "report"), resolve_range(*PERFORMANCE_DAYS)
    rows = materialize(operator_performance(spark, folder), "report")
    days.replace_days(rows, path, "rptDate", report)
    later = resolve_range("2024-01-15", PERFORMANCE_DAYS[1])
    days.replace_days(rows.where(later.covers(F.col("rptDate"))), path, "rptDate", later)
    return days.read_days(spark, path, rows.schema, report)


def operator_performance_stored(spark: SparkSession, folder: str) -> DataFrame:
    """The report from stored sums of its days: all but the last, one of them again, the last."""
    sources = _performance_sources(spark, folder)
    store = performance_plan.DayStore(_new_path(spark, "days"))
    for first, last in (("2024-01-08", "2024-01-20"), ("2024-01-10", "2024-01-10"),
                        ("2024-01-21", "2024-01-22")):
        store.refresh(sources, resolve_range(first, last))
    return store.report(sources.employees, resolve_range(*PERFORMANCE_DAYS))


def csc_session_match_bucketed(spark: SparkSession, folder: str) -> DataFrame:
    """The match through the cross reference, with both tables stored by call."""
    sources, window = _problem_sources(spark, folder), csc_range(*PROBLEM_DAYS)
    tables = {}
    for name in ("xref", "calls"):
        table = _new_name(name)
        buckets.write_bucketed(getattr(sources, name), table, _new_path(spark, name), "CallID", 16)
        tables[name] = spark.table(table)
    calls = problems.connected(problems.caption_slice(tables["calls"], window))
    locations = problems.company_locations(sources.intervals)
    linked = problems.at_company(problems.linked_calls(tables["xref"], calls), locations, COMPANY)
    reported = problems.reported_problems(sources.reports, sources.categories, window)
    return problems.csc_linked_match(reported, linked, window)


def caption_slice_by_day(spark: SparkSession, folder: str) -> DataFrame:
    """The slice of a call table that is laid out by day: only its days are read."""
    path, window = _new_path(spark, "caption"), csc_range(*PROBLEM_DAYS)
    calls = standins.caption_calls(spark, folder)
    ends = calls.agg(F.min("Handoff_Time"), F.max("Handoff_Time")).first()
    whole = Window(*(F.lit(str(end)).cast("timestamp_ntz") for end in ends), closed=True)
    days.replace_days(calls, path, "Handoff_Time", whole)
    return problems.caption_slice(days.read_days(spark, path, calls.schema, window.calls), window)


def _new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/ringledger/{label}-{uuid.uuid4().hex}"


def _new_name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex}"
