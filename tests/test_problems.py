from __future__ import annotations

import random
import re
from datetime import timedelta

import pytest

from ringledger.operators import problems as steps
from ringledger.operators.windows import csc_range
from ringledger.plans.problems import ProblemSources, candidate_calls, csc_report
from tests.conftest import at, physical_plan, pushed_filters


@pytest.fixture
def days(spark):
    return csc_range("2024-01-05", "2024-01-06")


def report(number=1, session="s1", category=1, code="PR4000", created="2024-01-05 10:00", data="n"):
    return {"ProblemReportID": number, "SessionID": session, "ProblemReportCategoryID": category,
            "ErrorCode": code, "DateCreated": at(created), "ProblemReportData": data}


def call(number="1", session="s1", time="2024-01-05 09:00", place="C1", answered=1, abandon=0,
         caller="7", phone="555"):
    return {"CallID": number, "csOprSessionID": session, "Handoff_Time": at(time),
            "OperatorID": "3", "locationcode": place, "Caption_PhoneNumber_Clean": phone,
            "Voice_PhoneNumber_Clean": "556", "Call_Type_Label": "in", "UserID_Caller": caller,
            "Answered": answered, "Abandon": abandon}


PLACES = [("A", "C1"), ("A", "C2"), ("A", "C1"), ("B", "C3"), ("", "C4"), (None, "C5"), ("B", None)]


def sources(table, reports, calls, links, places=PLACES):
    return ProblemSources(
        reports=table("PROBLEM_REPORTS", reports),
        categories=table(
            "PROBLEM_CATEGORIES",
            [{"ProblemReportCategoryID": i, "CategoryName": f"cat{i}"} for i in (1, 2)],
        ),
        calls=table("CAPTION_CALLS", calls),
        xref=table("CAPTION_XREF", [{"CallID": c, "SessionID": s} for c, s in links]),
        intervals=table(
            "CAPTION_INTERVALS", [{"companyname": c, "locationcode": p} for c, p in places]
        ),
    )


def test_companies_and_their_lists(table):
    pairs = steps.company_locations(sources(table, [], [], []).intervals)
    assert sorted(map(tuple, pairs.collect()), key=str) == [
        ("A", "C1"), ("A", "C2"), ("B", "C3"), ("B", None),
    ]
    lists = dict(map(tuple, steps.company_location_list(pairs).collect()))
    assert lists == {"A": "'C1','C2'", "B": "'C3'"}


@pytest.mark.parametrize(
    "company, kept",
    [("A", ["C1", "C2"]), ("B", ["C3"]), ("Nobody", []), (None, ["", "C1", "C2", "C3"])],
)
def test_company_filter(table, days, company, kept):
    calls = [call(str(i), place=p) for i, p in enumerate(["C1", "C2", "C3", "C4", "C5", "", None])]
    found = candidate_calls(sources(table, [], calls, []), days, company)
    assert sorted(r.locationcode for r in found.collect()) == kept
    assert found.columns == sources(table, [], calls, []).calls.columns


def test_slice_is_closed_and_reports_are_not(table, days):
    calls = [
        call(str(i), time=t)
        for i, t in enumerate(["2024-01-04 23:59:59", "2024-01-05 00:00", "2024-01-07 00:00",
                               "2024-01-07 00:00:01"])
    ]
    data = sources(table, [], calls, [])
    assert [r.CallID for r in steps.caption_slice(data.calls, days).collect()] == ["1", "2"]
    reports = [report(i, created=t) for i, t in enumerate(
        ["2024-01-04 23:59:59", "2024-01-05 00:00", "2024-01-06 23:59:59", "2024-01-07 00:00"])]
    reports += [report(8, code="PR1000"), report(9, category=5)]
    data = sources(table, reports, calls, [])
    kept = steps.reported_problems(data.reports, data.categories, days)
    assert sorted(r.ProblemReportID for r in kept.collect()) == [1, 2]


def test_only_connected_calls_match(table, days):
    calls = [call("1", answered=1), call("2", answered=0, abandon=1), call("3", answered=0),
             call("4", answered=None, abandon=None)]
    data = sources(table, [], calls, [])
    assert [r.CallID for r in steps.connected(data.calls).collect()] == ["1", "2"]


def test_a_report_matched_both_ways_is_listed_twice(table, days):
    data = sources(table, [report()], [call("1", session="s1")], [("1", "s1")])
    result = csc_report(data, days, "A")
    assert len(result.columns) == 15
    blank, full = sorted(result.collect(), key=lambda r: r.SessionID)
    assert full.SessionID == full.csOprSessionID == "s1"
    assert full.AssistedUserTelephoneNumber == "555"
    assert full.DialedorReceivedTelephoneNumber == "556"
    assert (full.CallType, full.UserID_Caller, full.CategoryName) == ("in", "7", "cat1")
    assert (blank.SessionID, blank.AssistedUserTelephoneNumber, blank.CallType) == ("", "", "")
    assert (blank.csOprSessionID, blank.Notes, blank.ErrorCode) == ("s1", "n", "PR4000")
    assert (blank.StartDate, blank.EndDate) == (at("2024-01-05"), at("2024-01-06"))


def test_rows_equal_in_both_matches_are_listed_once(table, days):
    # A blank session with blank caller fields looks alike however it was matched.
    row = call("1", session="", caller="", phone="")
    row |= {"Voice_PhoneNumber_Clean": "", "Call_Type_Label": ""}
    data = sources(table, [report(session="")], [row], [("1", "")])
    assert csc_report(data, days, "A").count() == 1


def test_calls_equal_in_shown_fields_are_listed_once(table, days):
    calls = [call("1", session="x"), call("2", session="x", time="2024-01-05 11:00")]
    data = sources(table, [report()], calls, [("1", "s1"), ("2", "s1")])
    assert csc_report(data, days, "A").count() == 1


def test_null_keys_never_match(table, days):
    data = sources(
        table, [report(session=None)], [call(None, session=None)], [(None, None), (None, "s1")]
    )
    assert csc_report(data, days, None).count() == 0


def test_order(table, days):
    reports = [report(i, session=f"s{i}", created=f"2024-01-05 {23 - i:02d}:00") for i in range(9)]
    calls = [call(str(i), session=f"s{i}") for i in range(9)]
    result = csc_report(sources(table, reports, calls, []), days, "A").collect()
    assert [r.ProblemReportID for r in result] == list(range(8, -1, -1))


def hot_data(seed):
    """Sessions, calls and copies of which one holds about a third of all rows."""
    rnd = random.Random(seed)

    def pick(hot, many):
        return hot if rnd.random() < 0.35 else rnd.randrange(many)

    start = at("2024-01-05")
    reports = [
        report(rnd.randrange(150), f"s{pick(0, 60)}", rnd.randrange(1, 4),
               rnd.choice(["PR4000", "PR4000", "PR1000"]),
               str(start + timedelta(hours=rnd.randrange(-5, 60))), rnd.choice("xyz"))
        for _ in range(400)
    ]
    calls = [
        call(f"c{pick(0, 300)}", f"s{pick(0, 60)}", str(start + timedelta(hours=rnd.randrange(60))),
             rnd.choice(["C1", "C1", "C2", "C3", "", None]), rnd.randrange(2), rnd.randrange(2),
             rnd.choice(["7", "8"]), rnd.choice(["555", "551"]))
        for _ in range(900)
    ]
    calls += [calls[0]] * 500  # a group of copies
    links = [(f"c{pick(0, 300)}", f"s{pick(0, 60)}") for _ in range(600)]
    links += [links[0]] * 300
    return reports, calls, links


def brute_force(reports, calls, links, places):
    first, last, after = at("2024-01-05"), at("2024-01-06"), at("2024-01-07")
    names = {1: "cat1", 2: "cat2"}
    reports = [r for r in reports if first <= r["DateCreated"] < after
               and r["ErrorCode"] == "PR4000" and r["ProblemReportCategoryID"] in names]
    calls = [c for c in calls if first <= c["Handoff_Time"] <= after
             and (c["Answered"] == 1 or c["Abandon"] == 1) and c["locationcode"] in places]
    result = set()

    def add(r, c, session, phones, label, caller):
        result.add((first, last, c["csOprSessionID"], r["DateCreated"], r["ProblemReportID"],
                    session, c["OperatorID"], c["locationcode"], *phones, label,
                    names[r["ProblemReportCategoryID"]], r["ProblemReportData"], caller,
                    r["ErrorCode"]))

    unique = {tuple(sorted(c.items(), key=lambda i: i[0])): c for c in calls}.values()
    for number, session in set(links):
        for r in (r for r in reports if r["SessionID"] == session):
            for c in (c for c in unique if c["CallID"] == number):
                phones = (c["Caption_PhoneNumber_Clean"], c["Voice_PhoneNumber_Clean"])
                add(r, c, session, phones, c["Call_Type_Label"], c["UserID_Caller"])
    for r in reports:
        for c in (c for c in unique if c["csOprSessionID"] == r["SessionID"]):
            add(r, c, "", ("", ""), "", "")
    return result


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
@pytest.mark.parametrize("company, places", [("A", {"C1", "C2"}), (None, {"C1", "C2", "C3", ""})])
def test_report_equals_brute_force_on_skewed_data(table, conf, days, broadcast, company, places):
    conf("spark.sql.autoBroadcastJoinThreshold", broadcast)
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", broadcast)
    reports, calls, links = hot_data(3)
    data = sources(table, reports, calls, links)
    result = [tuple(r) for r in csc_report(data, days, company).collect()]
    assert len(result) == len(set(result))
    assert set(result) == brute_force(reports, calls, links, places)


def test_matches_are_distinct_without_the_union(table, days):
    reports, calls, links = hot_data(4)
    data = sources(table, reports, calls, links)
    found = steps.reported_problems(data.reports, data.categories, days)
    wanted = candidate_calls(data, days, "A")
    for match in (
        steps.csc_session_match(found, data.xref, wanted, days),
        steps.csc_direct_match(found, wanted, days),
    ):
        rows = match.collect()
        assert rows and len(rows) == len(set(rows))


def test_hot_sessions_and_calls_are_split(spark, table, conf, days):
    """With small limits, adaptive execution must split the last join, and measured weights
    must have dealt out what the calls are looked up by."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "2KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.2")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1KB")
    conf("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1KB")
    conf("spark.sql.shuffle.partitions", "24")
    rnd = random.Random(1)
    links = [
        ("hot" if rnd.random() < 0.5 else f"c{i}", f"s{rnd.randrange(90)}") for i in range(4000)
    ]
    links += [(f"c{i}", "s0") for i in range(2000)]
    calls = [call(f"c{i}" if rnd.random() < 0.6 else "hot", f"s{rnd.randrange(90)}", phone=str(i))
             for i in range(3000)]
    reports = [
        report(i, f"s{rnd.randrange(90)}" if rnd.random() < 0.5 else "s0") for i in range(60)
    ]
    data = sources(table, reports, calls, links)
    rows = csc_report(data, days, "A").groupBy("ErrorCode").count()
    rows.collect()
    whole = physical_plan(rows)
    final = whole.split("Initial Plan")[0]
    assert re.search(r"SortMergeJoin\(skew=true\) \[SessionID#\d+\], \[SessionID#\d+\], Inner", final)
    for keys, kind in ((r"locationcode#\d+", "LeftSemi"), (r"SessionID#\d+", "LeftSemi"),
                       (r"kind#\d+, key#\d+", "Inner")):
        assert re.search(rf"Join.*\[{keys}, _salt#\d+\], .*{kind}", whole)


def test_each_source_is_read_once(spark, table, tmp_path, days):
    """Where the keys are small: one scan each, but for the reports, whose sessions are
    looked for before their categories are known; no job before an action."""
    reports, calls, links = hot_data(6)
    made = sources(table, reports, calls, links)
    paths = {name: str(tmp_path / name) for name in ("reports", "categories", "calls", "xref", "intervals")}
    for name, path in paths.items():
        getattr(made, name).write.parquet(path)
    data = ProblemSources(**{name: spark.read.parquet(path) for name, path in paths.items()})
    spark.sparkContext.setJobGroup("plan", "building the plan")
    result = csc_report(data, days, "A")
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("plan")
    result.collect()
    plan = physical_plan(result).split("Initial Plan")[0]
    assert plan.count("FileScan") == 4 + 3
    assert len(re.findall("Exchange (?:hash|range)", plan)) <= 6


def test_reports_alike_in_all_shown_fields_stay_apart(table, days):
    data = sources(table, [report(session="s1"), report(session="s2")],
                   [call("1", session="s1"), call("2", session="s2")], [("1", "s1"), ("1", "s2")])
    rows = csc_report(data, days, "A").collect()
    assert sorted(r.SessionID for r in rows) == ["", "", "s1", "s2"]


def test_the_slice_reaches_the_scan(spark, table, tmp_path, days):
    reports, calls, links = hot_data(5)
    path = str(tmp_path / "calls")
    table("CAPTION_CALLS", calls).write.parquet(path)
    data = sources(table, reports, [], links)
    data = ProblemSources(data.reports, data.categories, spark.read.parquet(path), data.xref,
                          data.intervals)
    # The size of these locations is unknown, so the calls are also counted by location.
    scans = pushed_filters(candidate_calls(data, days, "A"))
    assert scans
    for pushed in scans:
        assert "GreaterThanOrEqual(Handoff_Time,2024-01-05" in pushed
        assert "LessThanOrEqual(Handoff_Time,2024-01-07" in pushed
