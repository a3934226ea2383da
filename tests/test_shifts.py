from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ringledger.operators.shifts import covering_shifts, split_half_hours
from ringledger.operators.views import activity_time, labor_time
from tests.conftest import at, physical_plan

START = datetime(2024, 1, 5, 6)


def activity_rows(rnd, many):
    return [
        {"OperatorID": rnd.choice([None, 1, 1, 1, 2, 3]), "CallCenterCode": "C1", "EntryType": i,
         "AdjStartTime": rnd.choice([START + timedelta(minutes=15 * rnd.randrange(300))] * 9 + [None])}
        for i in range(many)
    ]


def shift_rows(rnd, many):
    rows = []
    for i in range(many):
        start = START + timedelta(minutes=15 * rnd.randrange(300))
        length = timedelta(minutes=rnd.choice([-30, 0, 15, 45, 480, 4000]))
        rows.append({"Emp_ID": rnd.choice([None, 1, 1, 2, 4]), "TaskName": str(i), "Station_Name": "S",
                     "adjShiftStart": rnd.choice([start] * 9 + [None]),
                     "adjShiftEnd": rnd.choice([start + length] * 9 + [None])})
    return rows


@pytest.mark.parametrize("cell_hours", [1, 24, 100])
def test_shifts_by_brute_force(table, cell_hours):
    rnd = random.Random(cell_hours)
    entries, shifts = activity_rows(rnd, 150), shift_rows(rnd, 60)
    activity = activity_time(table("SESSION_HISTORY", entries))
    labor = labor_time(table("SCHEDULE", shifts))
    found = covering_shifts(activity, labor, cell_hours=cell_hours)
    assert found.columns[: len(activity.columns)] == activity.columns
    assert "Shift_CallCenterCode" in found.columns
    expected = Counter()
    for e in entries:
        met = [
            s["TaskName"] for s in shifts
            if None not in (e["OperatorID"], e["AdjStartTime"], s["adjShiftStart"], s["adjShiftEnd"])
            and e["OperatorID"] == s["Emp_ID"]
            and s["adjShiftStart"] <= e["AdjStartTime"] < s["adjShiftEnd"]
        ]
        for task in met or [None]:
            expected[e["OperatorID"], e["AdjStartTime"], task] += 1
    got = Counter((r["OperatorID"], r["Activity_Begin_Time"], r["TaskType"]) for r in found.collect())
    assert got == expected and sum(k[2] is not None for k in got) > 20


def test_the_plan_has_no_nested_loop(table, conf):
    activity = activity_time(table("SESSION_HISTORY", activity_rows(random.Random(1), 9)))
    labor = labor_time(table("SCHEDULE", shift_rows(random.Random(1), 9)))
    for threshold in ("1GB", "-1"):
        conf("spark.sql.autoBroadcastJoinThreshold", threshold)
        plan = physical_plan(covering_shifts(activity, labor))
        assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "SortMergeJoin" in plan


def test_empty_sides(table):
    activity = activity_time(table("SESSION_HISTORY", activity_rows(random.Random(1), 9)))
    labor = labor_time(table("SCHEDULE", shift_rows(random.Random(1), 9)))
    assert covering_shifts(activity.limit(0), labor).collect() == []
    rows = covering_shifts(activity, labor.limit(0)).collect()
    assert len(rows) == 9 and all(r["ShiftStart"] is None for r in rows)


moments = st.none() | st.integers(0, 3 * 86_400 * 10**6).map(lambda n: START + timedelta(microseconds=n))
near = st.sampled_from([at("2024-01-05 07:00"), at("2024-01-05 07:30"), at("2024-01-06 00:00"),
                        at("2024-01-05 07:00:00.000001"), at("2024-01-05 07:29:59.999999")])


def brute_split(call, spans, minutes):
    """Rows of one call: interval, first, last, seconds by span."""
    sound = {n: call[a] is not None and call[b] is not None and call[a] <= call[b] for n, (a, b) in spans.items()}
    if not any(sound.values()):
        return [(None, 1, 1, *[None] * len(spans))]
    begin = min(call[a] for n, (a, _) in spans.items() if sound[n])
    end = max(call[b] for n, (_, b) in spans.items() if sound[n])
    step = timedelta(minutes=minutes)
    day = begin.replace(hour=0, minute=0, second=0, microsecond=0)
    slot = day + (begin - day) // step * step
    slots = [slot]
    while slots[-1] + step < end:
        slots.append(slots[-1] + step)
    rows = []
    for i, slot in enumerate(slots):
        seconds = []
        for n, (a, b) in spans.items():
            length = max(timedelta(0), min(call[b], slot + step) - max(call[a], slot)) if sound[n] else None
            seconds.append(None if length is None else Decimal(length // timedelta(microseconds=1)) / 10**6)
        rows.append((slot, int(i == 0), int(i == len(slots) - 1), *seconds))
    return rows


SPANS = {"SessionTime": ("SessionStart", "SessionEnd"), "ConvoTime": ("ConvoStart", "ConvoEnd")}


@given(st.lists(st.tuples(*[moments | near] * 4), min_size=1, max_size=30), st.sampled_from([30, 60]))
@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_splits_by_brute_force(spark, calls, minutes):
    names = ["SessionStart", "SessionEnd", "ConvoStart", "ConvoEnd"]
    rows = [(i, *c) for i, c in enumerate(calls)]
    df = spark.createDataFrame(rows, "CallID int, " + ", ".join(f"{n} timestamp_ntz" for n in names))
    got = Counter(
        (r["CallID"], r["Interval_Time"], r["First_Interval"], r["Last_Interval"], r["SessionTime"], r["ConvoTime"])
        for r in split_half_hours(df, SPANS, minutes).collect()
    )
    expected = Counter(
        (i, *row) for i, c in enumerate(calls) for row in brute_split(dict(zip(names, c)), SPANS, minutes)
    )
    assert got == expected


def test_seconds_add_up_to_the_spans(spark):
    rows = spark.range(500).select(
        F.col("id"),
        (F.lit("2024-01-05").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id") * 977)).alias("a"),
    ).withColumn("b", F.col("a") + F.make_dt_interval(secs=F.col("id") * 41))
    split = split_half_hours(rows, {"secs": ("a", "b")})
    totals = split.groupBy("id").agg(F.sum("secs").alias("s"), F.sum("First_Interval").alias("f"),
                                     F.sum("Last_Interval").alias("l")).collect()
    assert all(r["s"] == r["id"] * 41 and r["f"] == r["l"] == 1 for r in totals) and len(totals) == 500


def test_other_columns_pass_and_new_ones_are_replaced(spark):
    row = spark.sql("select 1 a, timestamp_ntz'2024-01-05 07:10' s, timestamp_ntz'2024-01-05 07:20' e,"
                    " 'x' First_Interval, 9 SessionTime")
    found = split_half_hours(row, {"SessionTime": ("s", "e")})
    assert found.columns == ["a", "s", "e", "Interval_Time", "First_Interval", "Last_Interval", "SessionTime"]
    assert found.first()["SessionTime"] == 600
    with pytest.raises(ValueError):
        split_half_hours(row, {"SessionTime": ("s", "e")}, minutes=7)
