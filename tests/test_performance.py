from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ringledger.functions.numbering import number_rows
from ringledger.functions.timeflags import time_flags
from ringledger.operators import performance as steps
from ringledger.operators.views import activity_time, labor_time
from ringledger.operators.windows import resolve_range
from ringledger.plans.performance import PerformanceSources, operator_days, performance_report
from tests.conftest import at, physical_plan

MONDAY = "2024-01-08"
SATURDAY = "2024-01-13"


@pytest.fixture
def week(spark):
    return resolve_range(MONDAY, "2024-01-14")


def call(time, operator=1, center="C1", convo=60, session=90):
    return {"Handoff_time": at(time), "OperatorID": operator, "LocationCode": center,
            "ConvoTime": convo, "SessionTime": session}


def flagged_calls(table, rows):
    flags = time_flags("Handoff_time")
    names = [flag.split(" as ")[1] for flag in flags]
    return table("RELAY_CALLS", rows).selectExpr(
        f"* except ({', '.join(names)})", *flags
    )


def session(time, operator=1, center="C1", kind=1, secs=120, login=600, teaming=60, away=30):
    start = at(time)
    return {"OperatorID": operator, "CallCenterCode": center,
            "Date": start.replace(hour=0, minute=0, second=0), "AdjStartTime": start,
            "AdjEndTime": start.fromtimestamp(start.timestamp() + secs), "EntryType": kind,
            "LoginTime": login, "TeamingTime": teaming, "BreakTime": away}


def shift(time, operator=1, center="C1", secs=1800, task="VRS", name="Sched"):
    start = at(time)
    return {"Date": start.replace(hour=0, minute=0, second=0), "HlfHrStart": start,
            "adjShiftStart": start, "adjShiftEnd": start, "Emp_ID": operator,
            "Employee_Name": name, "Station_Name": center, "TaskName": task, "LaborTime": secs}


def employee(key, name="Ann", active="True", adp="11", hired="2020-01-31", home="C9"):
    return {"ExternalID": key, "EmployeeName": name, "ADP_ID": adp, "DefaultLocation": home,
            "StaffType": "Full", "Language": "EN", "HireDate": at(hired), "Active": active}


def sources(table, calls=(), sessions=(), shifts=(), employees=()):
    return PerformanceSources(
        vrs=flagged_calls(table, list(calls)),
        vri=table("REMOTE_CALLS", []),
        relay=table("RELAY_CALLS", []),
        sessions=table("SESSION_HISTORY", list(sessions)),
        schedule=table("SCHEDULE", list(shifts)),
        employees=table("EMPLOYEES", list(employees)),
    )


def test_session_minutes_by_entry_type(table, week):
    rows = [
        session("2024-01-08 09:00", kind=1, secs=60),
        session("2024-01-08 10:00", kind=2, secs=120),
        session("2024-01-08 11:00", kind=6, secs=30),
        session("2024-01-08 12:00", kind=4, secs=900),
        session("2024-01-15 00:00", kind=1, secs=60),
        session("2024-01-07 00:00", kind=1, secs=60),
    ]
    found = steps.session_minutes(table("SESSION_HISTORY", rows), week).collect()
    # The day on which the range ends counts too, the day before the range does not.
    days = sorted(found, key=lambda row: row.Handoff_Date)
    assert [row.Handoff_Date for row in days] == [at("2024-01-08"), at("2024-01-15")]
    assert (days[0].BreakMins, days[0].TeamedMins, days[0].AvailableMins) == (
        Decimal("2.0000"), Decimal("0.5000"), Decimal("1.5000"),
    )
    assert days[0].Handoff_Date == at(MONDAY)


def test_call_buckets_and_range(table, week):
    rows = [
        call("2024-01-08 05:00", convo=60),
        call("2024-01-08 06:00", convo=120),
        call("2024-01-08 12:00", convo=20),
        call("2024-01-13 07:00", convo=600),
        call("2024-01-13 23:00", convo=60),
        call("2024-01-14 23:59:59", convo=60),
        call("2024-01-15 00:00", convo=6000),
        call("2024-01-07 23:59:59", convo=6000),
        call("2024-01-08 06:00", operator=None, convo=6000),
    ]
    calls = flagged_calls(table, rows).withColumn("Handoff_Date", F.to_date("Handoff_time"))
    days = {r.Handoff_Date: r for r in steps.bucket_calls(calls, week).collect()}
    monday, saturday = days[at(MONDAY)], days[at(SATURDAY)]
    assert len(days) == 3
    assert monday.AllDays_12to12_ConvoTime_Mins == Decimal("3.3333")
    assert monday.MtoF_NonCore_ConvoTime_Mins == 1
    assert monday.MtoF_6to12_ConvoTime_Mins == 2
    assert monday.MtoF_12to6_ConvoTime_Mins == Decimal("0.3333")
    assert monday.MtoF_6to6_ConvoTime_Mins == Decimal("2.3333")
    assert saturday.Sat_12to12_ConvoTime_Mins == 11
    assert saturday.Sat_6to6_ConvoTime_Mins == 10
    assert days[at("2024-01-14")].Sun_12to12_ConvoTime_Mins == 1


def test_hand_off_columns_can_be_named(table, week):
    rows = [call("2024-01-20 09:00")]
    adjusted = flagged_calls(table, rows).withColumns(
        {"adj_time": F.lit("2024-01-08 09:00").cast("timestamp_ntz"),
         "adj_date": F.lit("2024-01-08").cast("date")}
    )
    days = steps.bucket_calls(adjusted, week, "adj_time", "adj_date").collect()
    assert [d.Handoff_Date for d in days] == [at(MONDAY)]


def test_labor_counts_benchmark_tasks_and_takes_the_least_name(table, week):
    rows = [
        shift("2024-01-08 07:00", name="Zoe"),
        shift("2024-01-08 07:30", name="Amy"),
        shift("2024-01-08 08:00", task=None, name=None),
        shift("2024-01-08 08:30", task="Lunch", name="Aaron"),
        shift("2024-01-13 08:30"),
    ]
    days = {r.Handoff_Date: r for r in
            steps.labor_hours(labor_time(table("SCHEDULE", rows)), week).collect()}
    assert days[at(MONDAY)].OperatorName == "Amy"
    assert days[at(MONDAY)].AllDays_12to12_LaborTime_Hours == Decimal("1.5")
    assert days[at(MONDAY)].MtoF_6to6_LaborTime_Hours == Decimal("1.5")
    # Hours, despite the name.
    assert days[at(SATURDAY)].Sat_12to12_LaborTime_Mins == Decimal("0.5")


def test_login_entries_with_an_unknown_part_are_skipped(table, week):
    rows = [
        session("2024-01-08 09:00", login=600, teaming=60, away=30),
        session("2024-01-08 09:10", login=600, teaming=60, away=None),
    ]
    day = steps.login_minutes(activity_time(table("SESSION_HISTORY", rows)), week).collect()[0]
    assert day.AllDays_12to12_ActivityTime_Mins == Decimal("10.5")
    only = steps.login_minutes(
        activity_time(table("SESSION_HISTORY", rows[1:])), week
    ).collect()[0]
    assert only.AllDays_12to12_ActivityTime_Mins is None
    assert only.Sat_6to6_ActivityTime_Mins == 0


def test_employee_tenure(table, spark):
    operators = spark.createDataFrame([(1,), (1,), (2,), (None,)], "OperatorID int")
    staff = table(
        "EMPLOYEES",
        [employee(1, hired="2023-12-31 23:00"), employee(2, name=None), employee(3)],
    )
    row, = steps.employee_data(operators, staff, "2024-01-01 01:00").collect()
    assert (row.OperatorID, row.MnthsTenure, row.ADP_ID, row.Emp_RowNum) == (1, 1, 11, 1)
    assert row.YearTenure == Decimal("0.0002")  # two hour boundaries


def test_report_row(table, week):
    report = performance_report(
        sources(
            table,
            calls=[call("2024-01-08 09:00", convo=90, session=120)],
            sessions=[session("2024-01-08 09:00")],
            shifts=[shift("2024-01-08 09:00")],
            employees=[employee(1)],
        ),
        week,
    )
    assert len(report.columns) == 65
    row, = report.collect()
    assert (row.StartDate, row.EndDate) == (at(MONDAY), at("2024-01-15"))
    assert (row.HomeLocation, row.CallCenterCode, row.employee_name) == ("C9", "C1", "Ann")
    assert row.MtoF_6to12_ConvoTime_Mins == Decimal("1.5")
    assert row.AllDays_12to12_ConvoPctVSEnt == Decimal("0.05")
    assert row.MtoF_6ato12_ConvoPctVSEnt == Decimal("0.05")
    assert row.Sat_6to6_ConvoPctVSEnt == 0
    assert row.MtoF_NonCore_SatSun_SessionTime_Mins == 0
    kinds = dict(report.dtypes)
    assert kinds["MtoF_6to6_LaborTime_Hours"] == "decimal(18,4)"
    assert kinds["MtoF_6to6_ConvoTime_Mins"] == "decimal(17,4)"
    assert kinds["MtoF_NonCore_SatSun_ConvoTime_Mins"] == "decimal(18,4)"
    assert kinds["AllDays_12to12_ConvoPctVSEnt"] == "decimal(12,4)"


def test_missing_sides(table, week):
    days = operator_days(
        sources(
            table,
            calls=[call("2024-01-08 09:00"), call("2024-01-08 09:00", operator=2),
                   call("2024-01-09 09:00")],
            sessions=[session("2024-01-08 09:00", away=None),
                      session("2024-01-08 09:00", operator=2)],
            shifts=[shift("2024-01-08 09:00", operator=2, name="Scheduled")],
            employees=[employee(1, active="False")],
        ),
        week,
    )
    assert len(days.columns) == 56
    one, two = days.orderBy("OperatorID").collect()  # the call without session is gone
    assert (one.employee_name, one.HireDate, one.MnthsTenure) == ("Ann", None, 0)
    assert one.AllDays_12to12_LaborTime_Hours == 0
    assert one.AllDays_12to12_ActivityTime_Mins == 0
    assert (two.employee_name, two.HomeLocation, two.ADP_ID) == ("Scheduled", "C1", None)
    assert two.MnthsTenure is None


def test_employee_rows_multiply_report_rows(table, week):
    report = performance_report(
        sources(
            table,
            calls=[call("2024-01-08 09:00", convo=90), call("2024-01-08 09:00", operator=2)],
            sessions=[session("2024-01-08 09:00"), session("2024-01-08 09:00", operator=2)],
            shifts=[shift("2024-01-08 09:00"), shift("2024-01-08 15:00", operator=2)],
            employees=[employee(1), employee(1, name="Bob"), employee(1), employee(2, name="Cy")],
        ),
        week,
    ).collect()
    assert [(r.OperatorID, r.employee_name, r.Emp_RowNum) for r in report] == [
        (1, "Ann", 1), (1, "Bob", 2), (2, "Cy", 3),
    ]
    # Operator 1 counts twice: (1.5 + 1.5 + 1) / (0.5 * 3 * 60).
    assert report[0].AllDays_12to12_ConvoPctVSEnt == Decimal("0.0444")
    # Operator 2 has no morning labour, so its own ratio is 0.
    assert report[0].MtoF_6ato12_ConvoPctVSEnt == Decimal("0.0667")
    assert report[2].MtoF_6ato12_ConvoPctVSEnt == 0
    assert report[2].MtoF_12to6_ConvoPctVSEnt == 0


def test_report_order_and_labor_filter(table, week):
    places = [(2, "C2", "2024-01-08"), (1, "C1", "2024-01-09"), (1, "C1", "2024-01-08"),
              (3, "C1", "2024-01-08")]
    report = performance_report(
        sources(
            table,
            calls=[call(f"{day} 09:00", o, c) for o, c, day in places],
            sessions=[session(f"{day} 09:00", o, c) for o, c, day in places],
            shifts=[shift(f"{day} 09:00", o, c) for o, c, day in places[:3]],
        ),
        week,
    ).collect()
    assert [(r.CallCenterCode, r.rptDate, r.OperatorID) for r in report] == [
        ("C1", at("2024-01-08"), 1), ("C1", at("2024-01-09"), 1), ("C2", at("2024-01-08"), 2),
    ]


def test_numbers_are_consecutive_over_partitions(spark, conf):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    # A third of the rows share a name.
    df = spark.range(3000).selectExpr(
        "if(id % 3 = 0, 'same', concat('n', pmod(hash(id), 997))) as name", "id"
    )
    numbered = number_rows(df.repartition(7), ["name", "id"], "n").collect()
    expected = sorted((row.name, row.id) for row in df.collect())
    assert [(r.name, r.id) for r in sorted(numbered, key=lambda r: r.n)] == expected
    assert sorted(r.n for r in numbered) == list(range(1, 3001))


def test_intermediates_go_to_the_shared_folder(spark):
    df = number_rows(spark.range(5), ["id"], "n")
    assert all(spark.conf.get("spark.checkpoint.dir") in f for f in df.inputFiles())


def daily_steps(empty, week):
    calls = empty.vrs.withColumn("Handoff_Date", F.to_date("Handoff_time"))
    return (
        steps.bucket_calls(calls, week),
        steps.session_minutes(empty.sessions, week),
        steps.login_minutes(activity_time(empty.sessions), week),
        steps.labor_hours(labor_time(empty.schedule), week),
    )


def test_daily_joins_reuse_the_partitioning_of_the_aggregates(table, conf, week):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    buckets, sessions, login, labor = daily_steps(sources(table), week)
    joined = steps.with_login_minutes(steps.call_data(buckets, sessions), login)
    plan = physical_plan(steps.with_labor_hours(joined, labor))
    # One shuffle per aggregate, two for labour, and none for the three joins.
    assert plan.count("Exchange hashpartitioning") == 5
    assert plan.count("SortMergeJoin") == 3


def test_one_pass_over_sessions_equals_both_steps(table, week):
    rows = []
    for i in range(300):
        kind, away = i % 7, None if i % 11 == 0 else i % 40
        row = session(f"2024-01-{8 + i % 7:02d} {i % 24:02d}:{i % 60:02d}", i % 5, f"C{i % 2}",
                      kind, 17 * i % 900, 30 * i, i, away)
        rows.append(row)
    sessions = table("SESSION_HISTORY", rows)
    both = steps.session_minutes(sessions, week).join(
        steps.login_minutes(activity_time(sessions), week), steps.KEYS
    )
    once = steps.session_days(sessions, week)
    assert set(once.columns) == set(both.columns)
    order = [c for c in both.columns]
    assert once.select(order).orderBy(steps.KEYS).collect() == both.orderBy(steps.KEYS).collect()
    assert once.count() > 30


def test_entries_filed_at_a_time_of_day_have_no_login_time(table, week):
    odd = session("2024-01-08 09:00") | {"Date": at("2024-01-08 05:00")}
    row, = steps.session_days(table("SESSION_HISTORY", [odd]), week).collect()
    assert row.AvailableMins == 2
    assert row.AllDays_12to12_ActivityTime_Mins is None


def test_large_aggregates_are_hash_aggregates(table, week):
    empty = sources(table)
    buckets, sessions, login, labor = daily_steps(empty, week)
    for df in (buckets, sessions, login, steps.session_days(empty.sessions, week)):
        assert "SortAggregate" not in physical_plan(df)
    plan = physical_plan(labor)
    assert "HashAggregate" in plan[plan.rindex("SortAggregate"):]
