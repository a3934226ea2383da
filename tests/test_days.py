from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from ringledger.operators import problems
from ringledger.operators.windows import Window, csc_range, resolve_range
from ringledger.plans.performance import DayStore, PerformanceSources, operator_days, performance_report
from ringledger.sources import buckets, standins
from ringledger.sources.days import read_days, replace_days
from tests.conftest import DATA, physical_plan

SF = f"{DATA}/sf0.001"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def scanned(df, metric="number of files read"):
    """A metric of each file scan of a plan that ran."""
    df.collect()
    found = []

    def walk(node):
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            node = node.executedPlan()
        if hasattr(node, "plan") and "QueryStage" in node.getClass().getSimpleName():
            return walk(node.plan())
        metrics = node.metrics()
        if metrics.contains("numFiles"):
            found.append(metrics.apply("numFiles").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return found


@pytest.fixture
def calls(spark):
    return standins.caption_calls(spark, SF)


def whole(first="2024-01-01", last="2024-01-31"):
    return resolve_range(first, last)


def test_a_repeated_run_replaces_its_days_only(spark, calls, tmp_path):
    path = str(tmp_path / "t")
    replace_days(calls, path, "Handoff_Time", whole())
    everything = rows_of(read_days(spark, path, calls.schema, whole()))
    assert everything == rows_of(calls)
    days = resolve_range("2024-01-10", "2024-01-12")
    some = calls.where(days.covers(F.col("Handoff_Time")))
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}
    for _ in range(2):
        replace_days(some, path, "Handoff_Time", days)
        assert rows_of(read_days(spark, path, calls.schema, whole())) == everything
    kept = {p for p in files if not re.search("day=2024-01-1[012]", str(p))}
    assert kept and all(p.stat().st_mtime_ns == files[p] for p in kept)


def test_days_without_rows_come_out_empty(spark, calls, tmp_path):
    path = str(tmp_path / "t")
    replace_days(calls, path, "Handoff_Time", whole())
    days = resolve_range("2024-01-10", "2024-01-12")
    left = calls.where(F.col("Handoff_Time").cast("date") == F.lit("2024-01-11").cast("date"))
    replace_days(left, path, "Handoff_Time", days)
    assert rows_of(read_days(spark, path, calls.schema, days)) == rows_of(left)
    replace_days(left.limit(0), path, "Handoff_Time", days)
    assert read_days(spark, path, calls.schema, days).collect() == []
    outside = ~F.col("Handoff_Time").cast("date").between("2024-01-10", "2024-01-12")
    assert rows_of(read_days(spark, path, calls.schema, whole())) == rows_of(calls.where(outside))


def test_a_new_table_may_be_empty(spark, calls, tmp_path):
    path = str(tmp_path / "t")
    replace_days(calls.limit(0), path, "Handoff_Time", whole())
    assert read_days(spark, path, calls.schema, whole()).collect() == []


def test_rows_outside_the_days_are_refused(calls, tmp_path):
    for rows in (calls, calls.withColumn("Handoff_Time", F.lit(None).cast("timestamp_ntz"))):
        with pytest.raises(Exception, match="lies outside the days replaced"):
            replace_days(rows, str(tmp_path / "t"), "Handoff_Time", resolve_range("2024-01-10", "2024-01-12"))


def test_a_window_reads_its_days_only(spark, calls, tmp_path):
    path = str(tmp_path / "t")
    replace_days(calls, path, "Handoff_Time", whole())
    per_day = {}
    for p in (tmp_path / "t").rglob("*.parquet"):
        per_day[p.parent.name] = per_day.get(p.parent.name, 0) + 1
    window = csc_range("2024-01-05", "2024-01-06").calls  # closed: reaches midnight of the 7th
    found = problems.caption_slice(
        read_days(spark, path, calls.schema, window), csc_range("2024-01-05", "2024-01-06")
    )
    assert re.search(r"PartitionFilters: \[.*day#\d+ >= 2024-01-05.*day#\d+ <= 2024-01-07", physical_plan(found))
    assert scanned(found) == [sum(per_day[f"day=2024-01-0{d}"] for d in (5, 6, 7))]
    expected = problems.caption_slice(calls, csc_range("2024-01-05", "2024-01-06"))
    assert rows_of(found) == rows_of(expected)
    open_ = Window(window.start, window.stop)
    assert scanned(read_days(spark, path, calls.schema, open_)) == [
        sum(per_day[f"day=2024-01-0{d}"] for d in (5, 6))
    ]


# Stored sums of days.


def sources(spark, adjusted=False):
    made = PerformanceSources(
        standins.calls_vrs(spark, SF), standins.calls_vri(spark, SF), standins.calls_relay(spark, SF),
        standins.session_history(spark, SF), standins.schedule(spark, SF), standins.employees(spark, SF),
    )
    if not adjusted:
        return made
    # The day a call is filed under differs from the day of its time, in both directions.
    day = F.expr("date_add(cast(Handoff_time as date), cast(UserID_Caller % 3 as int) - 1)")

    def with_day(calls):
        return calls.withColumns({"time_adj": F.expr("Handoff_time + interval 5 hours"), "day_adj": day})

    return PerformanceSources(
        with_day(made.vrs), with_day(made.vri), with_day(made.relay), made.sessions, made.schedule,
        made.employees, "time_adj", "day_adj",
    )


@pytest.mark.parametrize("adjusted", [False, True])
def test_stored_days_give_the_report_of_a_full_run(spark, tmp_path, adjusted):
    made, store = sources(spark, adjusted), DayStore(str(tmp_path))
    for first, last in (("2024-01-07", "2024-01-11"), ("2024-01-12", "2024-01-12"), ("2024-01-13", "2024-01-15"),
                        ("2024-01-09", "2024-01-10")):
        store.refresh(made, resolve_range(first, last))
    for first, last in (("2024-01-08", "2024-01-14"), ("2024-01-12", "2024-01-12")):
        report = resolve_range(first, last)
        expected = rows_of(performance_report(made, report))
        assert expected and rows_of(store.report(made.employees, report)) == expected


def test_the_midnight_that_ends_a_range_counts_as_in_a_full_run(spark, tmp_path):
    """Session entries filed with a time of day, and calls filed under the next day."""
    made = sources(spark, adjusted=True)
    shifted = F.when(F.col("EntryType") % 2 == 0, F.col("Date") + F.expr("interval 7 hours")).otherwise(F.col("Date"))
    made = PerformanceSources(**{**made.__dict__, "sessions": made.sessions.withColumn("Date", shifted)})
    store = DayStore(str(tmp_path))
    store.refresh(made, resolve_range("2024-01-08", "2024-01-20"))
    report = resolve_range("2024-01-08", "2024-01-12")
    full = operator_days(made, report)
    assert full.where("rptDate = '2024-01-13'").count() > 0
    assert rows_of(store.days(made.employees, report)) == rows_of(full)


def test_a_new_day_reads_only_its_day_of_the_sources(spark, tmp_path):
    plain = sources(spark)
    names = {"vrs": "Handoff_time", "vri": "Handoff_time", "relay": "Handoff_time", "sessions": "Date",
             "schedule": "Date"}
    for name, moment in names.items():
        replace_days(getattr(plain, name), str(tmp_path / name), moment, whole())

    def laid_out(window):
        read = {n: read_days(spark, str(tmp_path / n), getattr(plain, n).schema, window) for n in names}
        return PerformanceSources(**read, employees=plain.employees)

    store, day = DayStore(str(tmp_path / "store")), resolve_range("2024-01-12", "2024-01-12")
    store.refresh(laid_out(resolve_range("2024-01-08", "2024-01-11")), resolve_range("2024-01-08", "2024-01-11"))
    new = laid_out(day)
    for name in names:
        files = list((tmp_path / name / "day=2024-01-12").glob("*.parquet"))
        assert scanned(getattr(new, name)) == [len(files)]
    store.refresh(new, day)
    report = resolve_range("2024-01-08", "2024-01-12")
    assert rows_of(store.report(plain.employees, report)) == rows_of(performance_report(plain, report))


def test_days_must_be_whole(spark, tmp_path):
    store = DayStore(str(tmp_path))
    with pytest.raises(ValueError, match="midnight"):
        store.refresh(sources(spark), resolve_range("2024-01-08 05:00", "2024-01-09"))


# Tables stored by call.


def test_calls_and_cross_reference_meet_without_an_exchange(spark, conf, calls, tmp_path):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    xref = standins.caption_xref(spark, SF)
    xref = xref.union(xref.limit(50))
    for name, df in (("xref_by_call", xref), ("calls_by_call", calls.union(calls.limit(70)))):
        buckets.write_bucketed(df, name, str(tmp_path / name), "CallID", 8)
    stored = [spark.table(n) for n in ("xref_by_call", "calls_by_call")]
    linked = problems.linked_calls(*stored)
    plan = physical_plan(linked)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert rows_of(linked) == rows_of(problems.linked_calls(xref, calls))
    days = csc_range("2024-01-05", "2024-01-24")
    reported = problems.reported_problems(
        standins.problem_reports(spark, SF), standins.problem_categories(spark, SF), days
    )
    assert rows_of(problems.csc_linked_match(reported, linked, days)) == rows_of(
        problems.csc_session_match(reported, xref, calls, days)
    )
