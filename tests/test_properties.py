"""Properties that hold on any data, checked on the test tables, and empty inputs."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from ringledger.functions.timeflags import CONVO, LABOR, SESSION, measure_name
from ringledger.operators.performance import REPORT_BUCKETS, REPORT_MEASURES
from ringledger.operators.windows import csc_range, resolve_range
from ringledger.plans.performance import PerformanceSources, performance_report
from ringledger.plans.problems import ProblemSources, csc_report
from ringledger.plans.retention import css_report
from ringledger.sources import standins
from tests.conftest import DATA

FOLDER = f"{DATA}/sf0.01"


@pytest.fixture(scope="module")
def report(spark):
    return contract.operator_performance(spark, FOLDER).collect()


def test_disjoint_buckets_add_up_to_all_days(report):
    parts = ["MtoF_6to12", "MtoF_12to6", "MtoF_NonCore", "Sat_12to12", "Sun_12to12"]
    for row in report:
        for measure in (LABOR, CONVO, SESSION):
            total = sum(row[measure_name(part, measure)] for part in parts)
            assert abs(total - row[measure_name("AllDays_12to12", measure)]) < 0.0005


def test_derived_buckets(report):
    for row in report:
        for measure in REPORT_MEASURES:
            by_bucket = {b: row[measure_name(b, measure)] for b in REPORT_BUCKETS}
            daytime = by_bucket["MtoF_6to12"] + by_bucket["MtoF_12to6"]
            off = by_bucket["MtoF_NonCore"] + by_bucket["Sat_12to12"] + by_bucket["Sun_12to12"]
            assert by_bucket["MtoF_6to6"] == pytest.approx(daytime)
            assert by_bucket["MtoF_NonCore_SatSun"] == pytest.approx(off)


def test_report_keys_are_unique_and_rows_have_labor(report):
    keys = [(r.CallCenterCode, r.OperatorID, r.rptDate) for r in report]
    assert len(keys) == len(set(keys))
    assert all(r.AllDays_12to12_LaborTime_Hours > 0 for r in report)


def test_the_day_ratio_is_the_share_of_the_days_totals(report):
    for day in {r.rptDate for r in report}:
        rows = [r for r in report if r.rptDate == day]
        convo = sum(r.AllDays_12to12_ConvoTime_Mins for r in rows)
        labor = sum(r.AllDays_12to12_LaborTime_Hours for r in rows)
        assert {r.AllDays_12to12_ConvoPctVSEnt for r in rows} == {round(convo / (labor * 60), 4)}


def test_ratios_of_scores_lie_between_zero_and_one(spark):
    rows = contract.css_report(spark, FOLDER).collect()
    assert rows
    for row in rows:
        assert 0 <= row.VIScore <= 1
        assert row.TerpUserScore <= row.PerfectScore


def test_the_union_keeps_every_call(spark):
    branches = [standins.calls_vrs, standins.calls_vri, standins.calls_relay]
    expected = [branch(spark, FOLDER).count() for branch in branches]
    counts = contract.split30_all(spark, FOLDER).groupBy("CallData_Type").count()
    found = {row.CallData_Type: row["count"] for row in counts.collect()}
    assert [found[kind] for kind in ("VRS", "VRI", "ConvoRelay")] == expected


def test_a_report_can_be_written_and_read_back(spark, tmp_path):
    path = str(tmp_path / "report")
    result = contract.css_report(spark, FOLDER)
    result.write.parquet(path)
    assert spark.read.parquet(path).orderBy("AgentID").collect() == result.collect()


def test_empty_sources_give_empty_reports(table):
    assert css_report(table("CALL_DETAIL", []), "2024-05-31").collect() == []
    sources = PerformanceSources(
        vrs=table("RELAY_CALLS", []),
        vri=table("REMOTE_CALLS", []),
        relay=table("RELAY_CALLS", []),
        sessions=table("SESSION_HISTORY", []),
        schedule=table("SCHEDULE", []),
        employees=table("EMPLOYEES", []),
    )
    assert performance_report(sources, resolve_range("2024-01-01", "2024-01-02")).collect() == []
    sources = ProblemSources(
        reports=table("PROBLEM_REPORTS", []),
        categories=table("PROBLEM_CATEGORIES", []),
        calls=table("CAPTION_CALLS", []),
        xref=table("CAPTION_XREF", []),
        intervals=table("CAPTION_INTERVALS", []),
    )
    for company in ("A", None):
        days = csc_range("2024-01-01", "2024-01-02")
        assert csc_report(sources, days, company).collect() == []


def test_performance_report_holds_without_broadcasts(spark, conf, report):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    again = contract.operator_performance(spark, FOLDER)
    assert again.agg(F.count("*")).first()[0] == len(report)
    assert again.collect() == report
