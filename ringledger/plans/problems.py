"""Report of problem reports matched to caption calls."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ringledger.operators import problems as steps
from ringledger.operators.windows import DayRange


ORDER = ["DateCreated", "ProblemReportID", "csOprSessionID", "SessionID", "UserID_Caller"]


@dataclass(frozen=True)
class ProblemSources:
    """Source tables of the report."""

    reports: DataFrame
    categories: DataFrame
    calls: DataFrame
    xref: DataFrame
    intervals: DataFrame


def candidate_calls(sources: ProblemSources, days: DayRange, company: str | None) -> DataFrame:
    """Calls that a report may be matched to."""
    sliced = steps.connected(steps.caption_slice(sources.calls, days))
    locations = steps.company_locations(sources.intervals)
    return steps.at_company(sliced, locations, company)


def csc_report(
    sources: ProblemSources, days: DayRange, company: str | None = None
) -> DataFrame:
    """Both kinds of match, each result row once, in order of creation.

    A report matched both ways is listed twice: with its caller and without. The
    further sort columns let the sort split reports created at the same moment.
    """
    problems = steps.reported_problems(sources.reports, sources.categories, days)
    sessions = steps.reported_sessions(sources.reports, days)
    calls = candidate_calls(sources, days, company)
    matches = steps.csc_matches(problems, sources.xref, calls, days, sessions)
    # Equal rows agree in the sort columns, so one exchange by ranges of these serves both
    # the removal of copies and the order.
    return matches.repartitionByRange(*ORDER).distinct().orderBy(*ORDER)
