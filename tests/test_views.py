from __future__ import annotations

from datetime import timedelta

import pytest

from ringledger.functions.timeflags import BUCKETS, bucket_sums, measure_name, time_flags
from ringledger.operators.views import activity_time, labor_time, split30_all
from ringledger.sources import schemas
from ringledger.sources.tables import read_source, typed
from tests.conftest import at


def test_time_flags(spark):
    # Friday to Monday, at the edges of the day parts.
    moments = [
        at(f"2024-01-{day:02d} {clock}")
        for day in (5, 6, 7, 8)
        for clock in ("00:00:00", "05:59:59", "06:00:00", "11:59:59", "12:00:00", "17:59:59",
                      "18:00:00", "23:59:59")
    ]
    df = spark.createDataFrame([(m,) for m in moments], "t timestamp_ntz")
    for row in df.selectExpr("t", *time_flags("t")).collect():
        hour, weekday = row.t.hour, row.t.weekday()
        assert row.isCoreHours == (6 <= hour < 18)
        assert row.isNonCoreHours == (not 6 <= hour < 18)
        assert row.is6to12Hours == (6 <= hour < 12)
        assert row.is12to18Hours == (12 <= hour < 18)
        assert row.isWeekdayHours == (weekday < 5)
        assert row.isSaturdayHours == (weekday == 5)
        assert row.isSundayHours == (weekday == 6)


def test_unknown_time_has_no_flag(spark):
    df = spark.createDataFrame([(None,)], "t timestamp_ntz").selectExpr(*time_flags("t"))
    assert set(df.collect()[0]) == {0}


def test_disjoint_buckets_add_up(spark):
    start = at("2024-01-01")
    rows = [(start + timedelta(minutes=37 * i), i % 91) for i in range(2000)]
    df = spark.createDataFrame(rows, "t timestamp_ntz, secs int")
    sums = df.selectExpr("secs", *time_flags("t")).agg(*bucket_sums("secs", "X")).first()
    parts = ["MtoF_NonCore", "MtoF_6to12", "MtoF_12to6", "Sat_12to12", "Sun_12to12"]
    assert sum(sums[measure_name(p, "X")] for p in parts) == sums["AllDays_12to12_X"]
    assert len(sums) == len(BUCKETS)


def test_unknown_amounts_are_skipped_inside_a_bucket(spark):
    rows = [(at("2024-01-06 08:00"), None), (at("2024-01-06 08:00"), 5), (at("2024-01-08"), None)]
    df = spark.createDataFrame(rows, "t timestamp_ntz, secs int")
    sums = df.selectExpr("secs", *time_flags("t")).agg(*bucket_sums("secs", "X")).first()
    assert sums["Sat_6to6_X"] == 5
    assert sums["Sun_12to12_X"] == 0
    # All rows are in this bucket and only one amount is known.
    assert sums["AllDays_12to12_X"] == 5


@pytest.mark.parametrize(
    "task, counts",
    [
        (None, 1), ("VRS", 1), ("VRI", 0), ("Bench Time", 1), ("Corporate Events", 1),
        ("Professional Development", 1), ("ISAS Rating", 1), ("Management", 1), ("Lunch", 0),
    ],
)
def test_benchmark_tasks(table, task, counts):
    row = labor_time(table("SCHEDULE", [{"Emp_ID": 1, "TaskName": task}])).collect()[0]
    assert row.IsBenchmarkTask == counts
    assert row.TaskType == task


def test_activity_names(table):
    row = activity_time(
        table("SESSION_HISTORY", [{"OperatorID": 3, "LoginTime": 1, "TeamingTime": 2,
                                   "BreakTime": 3, "AdjStartTime": at("2024-01-06 07:00"),
                                   "Date": at("2024-01-06")}])
    ).collect()[0]
    assert (row.LoginTime_Secs, row.TeamingTime_Secs, row.BreakTime_Secs) == (1, 2, 3)
    assert (row.isSaturdayHours, row.isCoreHours, row.is6to12Hours) == (1, 1, 1)
    assert row.Activity_Date == at("2024-01-06")


def test_relay_callers_without_id_are_told_apart_by_number(table):
    callers = [(0, "555"), (0, ""), (0, None), (1, "555"), (None, "555"), (-2, "1")]
    rows = [{"UserID_Caller": user, "PhoneNumber": phone} for user, phone in callers]
    empty = table("RELAY_CALLS", [])
    calls = split30_all(empty, table("REMOTE_CALLS", []), table("RELAY_CALLS", rows))
    assert [r.UserID_Caller_TDN for r in calls.collect()] == [
        "tdn_555", "0", "0", "1", None, "tdn_1",
    ]
    vrs = split30_all(table("RELAY_CALLS", rows), table("REMOTE_CALLS", []), empty)
    assert [r.UserID_Caller_TDN for r in vrs.collect()] == ["0", "0", "0", "1", None, "-2"]


def test_remote_calls_take_the_shared_shape(table):
    remote = table(
        "REMOTE_CALLS",
        [{"ConvoStart": at("2024-01-01 10:00"), "ConvoStart_RL": at("2024-01-01 10:01"),
          "ConvoEnd": at("2024-01-01 10:09"), "ConvoEnd_RL": at("2024-01-01 10:08"),
          "ConvoTime": 540, "r_ConvoTime": 420, "Video_PhoneNumber": "v",
          "Handoff_time": at("2024-01-01 10:00")}],
    )
    empty = table("RELAY_CALLS", [])
    df = split30_all(empty, remote, empty)
    row = df.collect()[0]
    assert len(df.columns) == 55
    assert row.CallData_Type == "VRI"
    assert row.SessionStart == at("2024-01-01 10:00")
    assert row.SessionStart_RL == row.ConvoStart == at("2024-01-01 10:01")
    assert row.ConvoEnd == row.SessionEnd_RL == at("2024-01-01 10:08")
    assert row.SessionEnd == at("2024-01-01 10:09")
    assert (row.SessionTime_Total, row.SessionTime, row.ConvoTime) == (540, 420, 420)
    assert (row.RLSA_ConvoTime, row.BillableTime) == (None, None)
    assert (row.PhoneNumber, row.RLSA_Disp, row.RLSA_Disp_Reason) == ("v", "C", "VRI")
    assert dict(df.dtypes)["BillableTime"] == "decimal(12,1)"


def test_sources_are_read_by_path_and_by_three_part_name(spark, table, tmp_path):
    rows = [{"OperatorID": 1, "UserID_Caller": 2, "timeWait": at("2024-01-01"), "Outbound": 1,
             "isReport": 1}]
    raw = table("CALL_DETAIL", rows).selectExpr(
        "'x' as extra", "* except (OperatorID)", "cast(OperatorID as bigint) as OperatorID"
    )
    path = str(tmp_path / "calls")
    raw.write.parquet(path)
    raw.write.mode("overwrite").saveAsTable("call_detail_copy")
    expected = table("CALL_DETAIL", rows).collect()
    for place in (path, "spark_catalog.default.call_detail_copy"):
        df = read_source(spark, place, schemas.CALL_DETAIL)
        assert df.collect() == expected
        assert dict(df.dtypes) == schemas.CALL_DETAIL
    df.createOrReplaceTempView("call_view")
    assert read_source(spark, "call_view", schemas.CALL_DETAIL).collect() == expected
    spark.sql("drop table call_detail_copy")


def test_a_source_keeps_its_values(spark, conf):
    wide = spark.sql("select 1.0D as n, 5L as m, 'x' as t")
    assert typed(wide, {"n": "int", "m": "int", "t": "string"}).collect() == [(1, 5, "x")]
    for value in ("7.9D", "3000000000L", "1.25D"):
        kind = "decimal(12,1)" if value == "1.25D" else "int"
        with pytest.raises(Exception, match="does not fit"):
            typed(spark.sql(f"select {value} as n"), {"n": kind}).collect()


@pytest.mark.parametrize("session", ["UTC", "America/New_York"])
def test_times_with_a_zone_need_one(spark, conf, session):
    conf("spark.sql.session.timeZone", session)
    moment = spark.sql("select timestamp_micros(1704679200123456) as t")  # 02:00:00.123456 UTC
    with pytest.raises(ValueError, match="zone"):
        typed(moment, {"t": "timestamp_ntz"})
    text = typed(moment, {"t": "timestamp_ntz"}, "UTC").selectExpr("cast(t as string)").first()[0]
    assert text == "2024-01-08 02:00:00.123456"
    text = typed(moment, {"t": "timestamp_ntz"}, "America/New_York").selectExpr("cast(t as string)")
    assert text.first()[0] == "2024-01-07 21:00:00.123456"
