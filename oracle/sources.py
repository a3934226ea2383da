"""Test tables in the shape of the source tables, as SQL common table expressions."""

from __future__ import annotations

OPERATOR = "CAST(user_id AS INTEGER)"
CENTER = "'C' || (user_id % 5)"
NUMBER = "CAST(event_id AS VARCHAR)"
VALUE = "CAST(floor(value) AS INTEGER)"
PHONE = (
    f"CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE '555' || {NUMBER} END"
)
DAY = "CAST(CAST(ts AS DATE) AS TIMESTAMP)"
HALF_HOUR = "time_bucket(INTERVAL 30 MINUTES, ts)"
ANSWERED = "CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END"
ABANDON = "CASE WHEN event_id % 5 = 1 THEN 1 ELSE 0 END"


def flags(moment: str) -> str:
    """Seven time flags. Monday to Sunday are 1 to 7 here."""
    hour, day = f"extract(hour FROM {moment})", f"extract(isodow FROM {moment})"
    tests = {
        "isCoreHours": f"{hour} >= 6 AND {hour} < 18",
        "isNonCoreHours": f"{hour} < 6 OR {hour} >= 18",
        "is6to12Hours": f"{hour} >= 6 AND {hour} < 12",
        "is12to18Hours": f"{hour} >= 12 AND {hour} < 18",
        "isWeekdayHours": f"{day} <= 5",
        "isSaturdayHours": f"{day} = 6",
        "isSundayHours": f"{day} = 7",
    }
    return ", ".join(
        f"CAST(CASE WHEN {test} THEN 1 ELSE 0 END AS INTEGER) AS {name}"
        for name, test in tests.items()
    )


SHARED_CALL = f"""
    {HALF_HOUR} AS Interval_Time, {NUMBER} AS CallID,
    1 AS First_Interval, 0 AS Last_Interval,
    's' || {NUMBER} AS SessionID, 'c' || {NUMBER} AS ConvoID, 'r' || {NUMBER} AS RLSA_ConvoID,
    0 AS Teaming, 'S' || ((event_id + 4) // 8) AS csOprSessionID,
    'o' || {NUMBER} AS oclOprSessionID, {OPERATOR} AS OperatorID,
    {CENTER} AS LocationCode, 'Center' AS CenterID, ts AS Handoff_time,
    {ABANDON} AS Abandon, 0 AS LostAbandon, {ANSWERED} AS Answered, 1 AS Incoming, 0 AS Outbound,
    {flags("ts")},
    1 AS isEnglishCall, 0 AS IsSpanishCall, CAST(NULL AS INTEGER) AS AbandonTime,
    5 AS AnsweredTime, 6 AS VI_AnswerTime, 7 AS csoprAcceptTime,
    'Brand' AS Branding, 'EN' AS LANGUAGE, 'Relay' AS Call_Type,
    CAST(user_id - 5 AS INTEGER) AS UserID_Caller, '556' || {NUMBER} AS Voice_PhoneNumber,
    'd' || {NUMBER} AS DeviceID
"""

RELAY_CALL = f"""
    ts AS SessionStart, ts + INTERVAL 1 SECOND AS SessionStart_RL,
    ts + INTERVAL 2 SECOND AS ConvoStart, ts + INTERVAL 3 SECOND AS ConvoEnd,
    ts + INTERVAL 4 SECOND AS SessionEnd_RL, ts + INTERVAL 5 SECOND AS SessionEnd,
    CAST({VALUE} + event_id % 60 + 1 AS INTEGER) AS SessionTime_Total,
    CAST({VALUE} + event_id % 60 AS INTEGER) AS SessionTime, {VALUE} AS ConvoTime,
    CAST(1.5 AS DOUBLE) AS RLSA_ConvoTime, CAST({VALUE} AS DOUBLE) AS BillableTime,
    {PHONE} AS PhoneNumber, 'B' AS RLSA_Disp, 'Reason' AS RLSA_Disp_Reason
"""

SOURCES = {
    "call_detail": """
        SELECT CAST(l_suppkey AS INTEGER) AS OperatorID,
               CAST(o_custkey AS INTEGER) AS UserID_Caller,
               o_orderdate AS timeWait,
               CAST(l_returnflag = 'N' AS INTEGER) AS Outbound,
               CAST(l_linestatus = 'O' AS INTEGER) AS isReport
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "calls_vrs": f"""
        SELECT {SHARED_CALL}, {RELAY_CALL} FROM events WHERE event_type IN ('click', 'signup')""",
    "calls_relay": f"""
        SELECT {SHARED_CALL}, {RELAY_CALL} FROM events
        WHERE event_type IS NULL OR event_type NOT IN ('click', 'signup', 'view', 'error')""",
    "calls_vri": f"""
        SELECT {SHARED_CALL},
               ts AS ConvoStart, ts + INTERVAL 1 SECOND AS ConvoStart_RL,
               ts + INTERVAL 4 SECOND AS ConvoEnd, ts + INTERVAL 3 SECOND AS ConvoEnd_RL,
               CAST({VALUE} + event_id % 60 AS INTEGER) AS ConvoTime, {VALUE} AS r_ConvoTime,
               {PHONE} AS Video_PhoneNumber
        FROM events WHERE event_type IN ('view', 'error')""",
    "raw_calls": f"""
        SELECT {NUMBER} AS CallID, ts AS SessionStart,
               ts + to_seconds({VALUE} * 30) AS SessionEnd,
               CASE WHEN event_id % 17 <> 0 THEN ts + INTERVAL 20 SECOND END AS ConvoStart,
               ts + to_seconds({VALUE} * 30 - 5) AS ConvoEnd
        FROM events""",
    "session_history": f"""
        SELECT {OPERATOR} AS OperatorID, {CENTER} AS CallCenterCode, {DAY} AS "Date",
               date_trunc('second', ts) AS AdjStartTime,
               date_trunc('second', ts) + to_seconds({VALUE}) AS AdjEndTime,
               CAST(event_id % 7 AS INTEGER) AS EntryType,
               {VALUE} * 3 AS LoginTime, CAST(event_id % 100 AS INTEGER) AS TeamingTime,
               CASE WHEN event_id % 10 <> 0 THEN CAST(event_id % 30 AS INTEGER) END AS BreakTime
        FROM events""",
    "schedule": f"""
        SELECT {DAY} AS "Date", {HALF_HOUR} AS HlfHrStart, {HALF_HOUR} AS adjShiftStart,
               {HALF_HOUR} + INTERVAL 30 MINUTE AS adjShiftEnd, {OPERATOR} AS Emp_ID,
               'Sched ' || user_id AS Employee_Name, {CENTER} AS Station_Name,
               CASE event_id % 9
                   WHEN 0 THEN 'VRS' WHEN 1 THEN 'VRI' WHEN 3 THEN 'Bench Time'
                   WHEN 4 THEN 'Corporate Events' WHEN 5 THEN 'Professional Development'
                   WHEN 6 THEN 'ISAS Rating' WHEN 7 THEN 'Management' WHEN 8 THEN 'Lunch'
               END AS TaskName,
               1800 AS LaborTime
        FROM events""",
    "employees": """
        SELECT CAST(s_suppkey AS INTEGER) AS ExternalID, s_name AS EmployeeName,
               CAST(s_suppkey + 1000 AS VARCHAR) AS ADP_ID,
               'C' || (s_nationkey % 5) AS DefaultLocation,
               CASE s_suppkey % 2 WHEN 0 THEN 'Full' ELSE 'Part' END AS StaffType,
               CASE s_suppkey % 3 WHEN 0 THEN 'ES' ELSE 'EN' END AS Language,
               CAST(DATE '2010-01-01' + CAST(s_suppkey * 37 AS INTEGER) AS TIMESTAMP) AS HireDate,
               CAST(NULL AS TIMESTAMP) AS TermDate,
               CASE s_suppkey % 7 WHEN 0 THEN 'False' ELSE 'True' END AS Active
        FROM supplier""",
    "problem_reports": """
        SELECT CAST(event_id AS INTEGER) AS ProblemReportID, 'S' || (event_id // 8) AS SessionID,
               CAST(event_id % 4 AS INTEGER) AS ProblemReportCategoryID,
               props AS ProblemReportData,
               CASE event_id % 3 WHEN 0 THEN 'PR4000' ELSE 'PR1000' END AS ErrorCode,
               ts AS DateCreated
        FROM events""",
    "problem_categories": """
        SELECT r_regionkey AS ProblemReportCategoryID, r_name AS CategoryName FROM region""",
    "caption_calls": f"""
        SELECT {NUMBER} AS CallID, 'S' || ((event_id + 4) // 8) AS csOprSessionID,
               ts AS Handoff_Time, CAST(user_id AS VARCHAR) AS OperatorID,
               CASE WHEN event_id % 11 = 0 THEN '' WHEN event_id % 13 <> 0 THEN {CENTER} END
                   AS locationcode,
               '555' || {NUMBER} AS Caption_PhoneNumber_Clean,
               '556' || {NUMBER} AS Voice_PhoneNumber_Clean,
               event_type AS Call_Type_Label, CAST(user_id AS VARCHAR) AS UserID_Caller,
               {ANSWERED} AS Answered, {ABANDON} AS Abandon
        FROM events""",
    "caption_xref": f"""
        SELECT {NUMBER} AS CallID, 'S' || (event_id // 8) AS SessionID
        FROM events""",
    "caption_intervals": """
        SELECT CASE WHEN n_nationkey = 24 THEN '' WHEN n_nationkey % 5 = 0 THEN 'Company A'
                    WHEN n_nationkey % 5 IN (1, 2) THEN 'Company B' ELSE 'Company C'
               END AS companyname,
               'C' || (n_nationkey % 5) AS locationcode
        FROM nation""",
}
