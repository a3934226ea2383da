"""Steps that match problem reports to caption calls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringledger.functions.skew import spread_join, spread_semi_join
from ringledger.operators.windows import DayRange

# Fixed value: the error code of the reports that are matched.
REPORTED_ERROR = "PR4000"

# Columns of a report that appear in the result, beside its session.
REPORT_FIELDS = [
    "DateCreated",
    "ProblemReportID",
    "CategoryName",
    "ProblemReportData",
    "ErrorCode",
]
# Columns of a call that appear in the result of each kind of match.
PLACE_FIELDS = ["csOprSessionID", "OperatorID", "locationcode"]
CALLER_FIELDS = [
    "Caption_PhoneNumber_Clean",
    "Voice_PhoneNumber_Clean",
    "Call_Type_Label",
    "UserID_Caller",
]


def company_locations(intervals: DataFrame) -> DataFrame:
    """Distinct pairs of company and location. Rows without a company are left out."""
    return (
        intervals.where(F.col("companyname") != "")
        .select("companyname", "locationcode")
        .distinct()
    )


def company_location_list(locations: DataFrame) -> DataFrame:
    """Each company's location codes as one quoted, comma-separated text."""
    quoted = F.concat(F.lit("'"), F.col("locationcode"), F.lit("'"))
    return locations.groupBy("companyname").agg(
        F.array_join(F.sort_array(F.collect_set(quoted)), ",").alias("locationcodes")
    )


def caption_slice(calls: DataFrame, days: DayRange) -> DataFrame:
    """Caption calls handed off within the range, all columns."""
    return calls.where(days.calls.covers(F.col("Handoff_Time")))


def at_company(calls: DataFrame, locations: DataFrame, company: str | None) -> DataFrame:
    """Calls at the company's locations.

    Without a company, calls at any listed location or at the empty one; a call with
    no location at all is left out either way. An unknown company has no calls.

    The codes are joined whatever their number; a location that holds much of the calls is
    spread over tasks by its measured weight.
    """
    if company is not None:
        locations = locations.where(F.col("companyname") == company)
    codes = locations.select("locationcode")
    if company is None:
        codes = codes.union(calls.sparkSession.range(1).select(F.lit("")))
    return spread_semi_join(calls, codes, "locationcode")


def connected(calls: DataFrame) -> DataFrame:
    """Calls that were answered or abandoned."""
    return calls.where((F.col("Answered") == 1) | (F.col("Abandon") == 1))


def reported_problems(reports: DataFrame, categories: DataFrame, days: DayRange) -> DataFrame:
    """Distinct reports of the matched error within the range, with their category."""
    return (
        _reported(reports, days)
        .join(categories, "ProblemReportCategoryID")
        .select("SessionID", *REPORT_FIELDS)
        .distinct()
    )


def _reported(reports: DataFrame, days: DayRange) -> DataFrame:
    in_range = days.reports.covers(F.col("DateCreated"))
    return reports.where(in_range & (F.col("ErrorCode") == REPORTED_ERROR))


def reported_sessions(reports: DataFrame, days: DayRange) -> DataFrame:
    """Sessions of the reports of the matched error within the range, with copies."""
    return _reported(reports, days).select("SessionID")


def csc_matches(
    problems: DataFrame,
    xref: DataFrame,
    calls: DataFrame,
    days: DayRange,
    sessions: DataFrame | None = None,
) -> DataFrame:
    """Both kinds of match in one pass over the calls, each row once except for one case.

    ``problems`` comes from ``reported_problems``; ``calls`` are the connected calls of the
    slice at the wanted locations. ``sessions`` are the sessions to look for, by default
    those of ``problems``; others among them do no harm.

    A call is looked up by its id, for the sessions that the cross reference gives it, and
    by its own session. Rows that both kinds show alike come from an empty session in the
    cross reference and a call without a caller; they are left to the caller to remove.
    """
    wanted = problems.select("SessionID") if sessions is None else sessions
    keys = _through_xref(wanted, xref).unionByName(_by_session(wanted))
    return _matched(problems, keys, calls, days, [CALL, SESSION])


def csc_session_match(
    problems: DataFrame,
    xref: DataFrame,
    calls: DataFrame,
    days: DayRange,
    sessions: DataFrame | None = None,
) -> DataFrame:
    """Reports joined to calls through the session-to-call cross reference, each row once.

    The parameters are those of ``csc_matches``. The cross reference is reduced to the
    sessions sought and made distinct before it meets the calls, so a session with many
    copies of a call costs one row.
    """
    wanted = problems.select("SessionID") if sessions is None else sessions
    return _matched(problems, _through_xref(wanted, xref), calls, days, [CALL])


def csc_direct_match(problems: DataFrame, calls: DataFrame, days: DayRange) -> DataFrame:
    """Reports joined to calls by the operator's session, each row once; no caller fields."""
    return _matched(problems, _by_session(problems.select("SessionID")), calls, days, [SESSION])


def linked_calls(xref: DataFrame, calls: DataFrame) -> DataFrame:
    """The calls of each session of the cross reference, once: ``SessionID`` and call columns.

    Where both tables are stored in the same buckets of ``CallID``, nothing here is
    shuffled: copies go within a bucket, and buckets meet their like.
    """
    fields = ["CallID", *PLACE_FIELDS, *CALLER_FIELDS]
    links = xref.select("SessionID", "CallID").distinct()
    return links.join(calls.select(*fields).distinct(), "CallID")


def csc_linked_match(problems: DataFrame, linked: DataFrame, days: DayRange) -> DataFrame:
    """``csc_session_match`` from ``linked_calls``, for tables stored by call."""
    fields = [*PLACE_FIELDS, *CALLER_FIELDS]
    reached = linked.select("SessionID", *fields).distinct()
    caller = [F.col(name).cast("string") for name in CALLER_FIELDS]
    return problems.join(reached, "SessionID").select(*_result(days, F.col("SessionID"), caller))


# Kinds of match, by what a call is looked up by, and the column that holds it.
CALL, SESSION = "call", "session"
_LOOKED_UP = {CALL: "CallID", SESSION: "csOprSessionID"}


def _through_xref(wanted: DataFrame, xref: DataFrame) -> DataFrame:
    links = spread_semi_join(xref.select("SessionID", "CallID"), wanted, "SessionID")
    return links.select(F.lit(CALL).alias("kind"), F.col("CallID").alias("key"), "SessionID")


def _by_session(wanted: DataFrame) -> DataFrame:
    return wanted.select(F.lit(SESSION).alias("kind"), F.col("SessionID").alias("key"), "SessionID")


def _matched(
    problems: DataFrame, keys: DataFrame, calls: DataFrame, days: DayRange, kinds: list[str]
) -> DataFrame:
    """Reports beside the calls found by ``kind, key, SessionID``.

    Keys and reached calls are distinct when they meet the next side, so copies cost one
    row and every pair that the last join emits is a result row. The calls are spread by
    the measured weight of their keys; the last join shuffles on a key that no aggregation
    around it shares, which leaves adaptive execution free to split a session.
    """
    through = F.col("kind") == CALL
    shown = [F.when(through, F.col(name).cast("string")).otherwise("").alias(name) for name in CALLER_FIELDS]
    looked_up = [F.struct(F.lit(k).alias("kind"), F.col(_LOOKED_UP[k]).alias("key")) for k in kinds]
    sought = calls.select(*PLACE_FIELDS, *CALLER_FIELDS, F.inline(F.array(*looked_up)))
    sought = sought.where(F.col("key").isNotNull())
    reached = (
        spread_join(sought, keys.distinct(), ["kind", "key"])
        .select("kind", "SessionID", *PLACE_FIELDS, *shown)
        .distinct()
    )
    session = F.when(through, F.col("SessionID")).otherwise("")
    caller = [F.col(name) for name in CALLER_FIELDS]
    return problems.join(reached, "SessionID").select(*_result(days, session, caller))


def _result(days: DayRange, session: Column, caller: list[Column]) -> list[Column]:
    """The 15 report columns, in order."""
    assisted, dialed, call_type, user = caller
    return [
        days.reports.start.alias("StartDate"),
        days.last.cast("timestamp_ntz").alias("EndDate"),
        F.col("csOprSessionID"),
        F.col("DateCreated"),
        F.col("ProblemReportID"),
        session.alias("SessionID"),
        F.col("OperatorID").cast("string").alias("OperatorID"),
        F.col("locationcode"),
        assisted.alias("AssistedUserTelephoneNumber"),
        dialed.alias("DialedorReceivedTelephoneNumber"),
        call_type.alias("CallType"),
        F.col("CategoryName"),
        F.col("ProblemReportData").alias("Notes"),
        user.alias("UserID_Caller"),
        F.col("ErrorCode"),
    ]
