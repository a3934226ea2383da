"""One DuckDB query per registered name.

Decimals are rounded as decimals and then returned as doubles, on both sides.
"""

from __future__ import annotations

from oracle.sources import SOURCES, flags

# Buckets with the flag columns each one needs.
BUCKETS = [
    ("AllDays_12to12", []),
    ("MtoF_NonCore", ["isWeekdayHours", "isNonCoreHours"]),
    ("MtoF_6to12", ["isWeekdayHours", "is6to12Hours"]),
    ("MtoF_12to6", ["isWeekdayHours", "is12to18Hours"]),
    ("Sat_12to12", ["isSaturdayHours"]),
    ("Sat_6to6", ["isSaturdayHours", "isCoreHours"]),
    ("Sun_12to12", ["isSundayHours"]),
    ("Sun_6to6", ["isSundayHours", "isCoreHours"]),
]
KEYS = "CallCenterCode, OperatorID, Handoff_Date"
FIRST, AFTER = "TIMESTAMP '2024-01-08'", "TIMESTAMP '2024-01-22'"


def column(bucket: str, measure: str) -> str:
    name = f"{bucket}_{measure}"
    return name.replace("Sat_12to12_LaborTime_Hours", "Sat_12to12_LaborTime_Mins")


def bucket_columns(amount: str, measure: str, unit: int) -> str:
    """Bucket sums in minutes or hours, to four places."""
    parts = []
    for bucket, needed in BUCKETS:
        test = " AND ".join(f"{name} = 1" for name in needed) or "TRUE"
        total = f"SUM(CASE WHEN {test} THEN {amount} ELSE 0 END)"
        parts.append(
            f"CAST({total} / {unit}.0 AS DECIMAL(17,4)) AS {column(bucket, measure)}"
        )
    return ", ".join(parts)


def daytime(measure: str) -> str:
    morning, noon = column("MtoF_6to12", measure), column("MtoF_12to6", measure)
    return f"COALESCE({morning}, 0) + COALESCE({noon}, 0) AS MtoF_6to6_{measure}"


def doubles(names: list[str]) -> str:
    return ", ".join(f"CAST({name} AS DOUBLE) AS {name}" for name in names)


def measures(measure: str) -> list[str]:
    return [*[column(bucket, measure) for bucket, _ in BUCKETS], f"MtoF_6to6_{measure}"]


MEASURES = ["LaborTime_Hours", "ConvoTime_Mins", "SessionTime_Mins", "ActivityTime_Mins"]
RATIO_BUCKETS = {
    "AllDays_12to12": "AllDays_12to12",
    "MtoF_6ato12": "MtoF_6to12",
    "MtoF_12to6": "MtoF_12to6",
    "Sat_12to12": "Sat_12to12",
    "Sat_6to6": "Sat_6to6",
    "Sun_12to12": "Sun_12to12",
    "Sun_6to6": "Sun_6to6",
    "MtoF_NonCore": "MtoF_NonCore",
    "MtoF_NonCore_SatSun": "MtoF_NonCore_SatSun",
}


def day_measures() -> str:
    """The 40 measures of an operator-day, unknown ones as 0."""
    parts = []
    for measure in MEASURES:
        parts += [f"COALESCE({name}, 0) AS {name}" for name in measures(measure)]
        off = ["MtoF_NonCore", "Sat_12to12", "Sun_12to12"]
        total = " + ".join(f"COALESCE({column(bucket, measure)}, 0)" for bucket in off)
        parts.append(f"{total} AS MtoF_NonCore_SatSun_{measure}")
    return ", ".join(parts)


def day_measure_names() -> list[str]:
    return [
        name
        for measure in MEASURES
        for name in [*measures(measure), f"MtoF_NonCore_SatSun_{measure}"]
    ]


def daily_ratios() -> str:
    parts = []
    for name, bucket in RATIO_BUCKETS.items():
        labor = f"SUM({column(bucket, 'LaborTime_Hours')})"
        convo = f"SUM({bucket}_ConvoTime_Mins)"
        share = f"CAST({convo} AS DOUBLE) / NULLIF(CAST({labor} AS DOUBLE) * 60.0, 0)"
        parts.append(
            f"CAST(CASE WHEN {labor} = 0 THEN 0 ELSE {share} END AS DECIMAL(12,4))"
            f" AS {name}_ConvoPctVSEnt"
        )
    return ", ".join(parts)


def shown_ratios() -> str:
    return ", ".join(
        f"CAST(CASE WHEN {column(bucket, 'LaborTime_Hours')} = 0 THEN 0"
        f" ELSE {name}_ConvoPctVSEnt END AS DOUBLE) AS {name}_ConvoPctVSEnt"
        for name, bucket in RATIO_BUCKETS.items()
    )


RATIO_NAMES = [f"{name}_ConvoPctVSEnt" for name in RATIO_BUCKETS]

# Steps of the reports, in an order that lets each refer to those before it.
STEPS = {
    **SOURCES,
    # Monthly retention.
    "reported": """
        SELECT OperatorID, UserID_Caller, timeWait,
               timeWait >= TIMESTAMP '1998-05-01' AS is_current
        FROM call_detail
        WHERE Outbound = 1 AND isReport = 1 AND UserID_Caller > 1
          AND timeWait >= TIMESTAMP '1998-04-01' AND timeWait < TIMESTAMP '1998-06-01'""",
    "user_scores": """
        SELECT UserID, PriorMonth1, PriorMonth2,
               CASE WHEN PriorMonth2 = 0 THEN 0
                    WHEN PriorMonth1 * 100 >= PriorMonth2 * 95 THEN 3 ELSE 2 END AS UserScore
        FROM (SELECT UserID_Caller AS UserID,
                     COUNT(*) FILTER (WHERE is_current) AS PriorMonth1,
                     COUNT(*) FILTER (WHERE NOT is_current) AS PriorMonth2
              FROM reported GROUP BY ALL)""",
    "terp_scores": """
        SELECT DISTINCT OperatorID AS AgentID, UserID_Caller AS UserID, UserScore AS TerpScore
        FROM reported LEFT JOIN user_scores ON UserID = UserID_Caller""",
    "outbound": """
        SELECT OperatorID AS AgentID, COUNT(*) AS OutboundCalls
        FROM reported WHERE is_current GROUP BY ALL""",
    "agent_scores": """
        SELECT AgentID, OutboundCalls, TerpUserScore, 3 * rated AS PerfectScore,
               CAST(CAST(CAST(TerpUserScore AS DOUBLE) / CASE rated WHEN 0 THEN 1 ELSE 3 * rated END
                    AS DECIMAL(15,10)) AS DOUBLE) AS VIScore
        FROM (SELECT AgentID, SUM(TerpScore) AS TerpUserScore,
                     COUNT(*) FILTER (WHERE TerpScore >= 2) AS rated
              FROM terp_scores GROUP BY AgentID)
        JOIN outbound USING (AgentID)""",
    # The same report with months that end at midnight of their last day.
    "closed_calls": """
        SELECT OperatorID, UserID_Caller,
               timeWait BETWEEN TIMESTAMP '1998-05-01' AND TIMESTAMP '1998-05-31' AS is_current,
               timeWait BETWEEN TIMESTAMP '1998-04-01' AND TIMESTAMP '1998-04-30' AS is_prior
        FROM call_detail
        WHERE Outbound = 1 AND isReport = 1 AND UserID_Caller > 1
          AND timeWait BETWEEN TIMESTAMP '1998-04-01' AND TIMESTAMP '1998-05-31'""",
    "closed_scores": """
        SELECT UserID_Caller, CASE WHEN prior_calls = 0 THEN 0
                                   WHEN current_calls * 100 >= prior_calls * 95 THEN 3
                                   ELSE 2 END AS points
        FROM (SELECT UserID_Caller, COUNT(*) FILTER (WHERE is_current) AS current_calls,
                     COUNT(*) FILTER (WHERE is_prior) AS prior_calls
              FROM closed_calls GROUP BY UserID_Caller)""",
    "closed_pairs": """
        SELECT OperatorID, UserID_Caller, COUNT(*) FILTER (WHERE is_current) AS current_calls
        FROM closed_calls WHERE OperatorID IS NOT NULL GROUP BY ALL""",
    "closed_agents": """
        SELECT OperatorID, SUM(current_calls) AS calls, SUM(points) AS points,
               3 * COUNT(*) FILTER (WHERE points >= 2) AS best
        FROM closed_pairs JOIN closed_scores USING (UserID_Caller) GROUP BY OperatorID""",
    # Views.
    "activity": f"""
        SELECT OperatorID, CallCenterCode, "Date" AS Activity_Date,
               AdjStartTime AS Activity_Begin_Time, AdjEndTime AS Activity_End_Time,
               LoginTime AS LoginTime_Secs, TeamingTime AS TeamingTime_Secs,
               BreakTime AS BreakTime_Secs, {flags("AdjStartTime")}
        FROM session_history""",
    "labor": f"""
        SELECT "Date" AS ShiftDate, HlfHrStart AS Interval_Begin, adjShiftStart AS ShiftStart,
               adjShiftEnd AS ShiftEnd, Emp_ID AS OperatorID, Employee_Name AS OperatorName,
               Station_Name AS CallCenterCode, LaborTime AS LaborTime_Secs, TaskName AS TaskType,
               CASE WHEN TaskName IS NULL THEN 1
                    WHEN TaskName IN ('VRI', 'Lunch') THEN 0 ELSE 1 END AS IsBenchmarkTask,
               {flags("adjShiftStart")}
        FROM schedule""",
    "calls": """
        SELECT *, 'VRS' AS CallData_Type, CAST(UserID_Caller AS VARCHAR) AS UserID_Caller_TDN,
               CAST(Handoff_time AS DATE) AS Handoff_Date
        FROM calls_vrs
        UNION ALL BY NAME
        SELECT * EXCLUDE (ConvoStart, ConvoStart_RL, ConvoEnd, ConvoEnd_RL, ConvoTime,
                          r_ConvoTime, Video_PhoneNumber),
               'VRI' AS CallData_Type, CAST(UserID_Caller AS VARCHAR) AS UserID_Caller_TDN,
               CAST(Handoff_time AS DATE) AS Handoff_Date,
               ConvoTime AS SessionTime_Total, r_ConvoTime AS SessionTime,
               r_ConvoTime AS ConvoTime,
               ConvoStart AS SessionStart, ConvoEnd AS SessionEnd,
               ConvoStart_RL AS SessionStart_RL, ConvoStart_RL AS ConvoStart,
               ConvoEnd_RL AS SessionEnd_RL, ConvoEnd_RL AS ConvoEnd,
               Video_PhoneNumber AS PhoneNumber, 'VRI' AS RLSA_Disp_Reason, 'C' AS RLSA_Disp,
               CAST(NULL AS DOUBLE) AS BillableTime, CAST(NULL AS DOUBLE) AS RLSA_ConvoTime
        FROM calls_vri
        UNION ALL BY NAME
        SELECT *, 'ConvoRelay' AS CallData_Type,
               CASE WHEN UserID_Caller < 1 AND PhoneNumber <> '' THEN 'tdn_' || PhoneNumber
                    ELSE CAST(UserID_Caller AS VARCHAR) END AS UserID_Caller_TDN,
               CAST(Handoff_time AS DATE) AS Handoff_Date
        FROM calls_relay""",
    # Daily performance.
    "session_days": f"""
        SELECT CallCenterCode, OperatorID, CAST(CAST("Date" AS DATE) AS TIMESTAMP) AS Handoff_Date,
               CAST(SUM(CASE WHEN EntryType = 2 THEN secs ELSE 0 END) / 60.0 AS DECIMAL(17,4))
                   AS BreakMins,
               CAST(SUM(CASE WHEN EntryType = 6 THEN secs ELSE 0 END) / 60.0 AS DECIMAL(17,4))
                   AS TeamedMins,
               CAST(SUM(CASE WHEN EntryType IN (1, 6) THEN secs ELSE 0 END) / 60.0
                   AS DECIMAL(17,4)) AS AvailableMins
        FROM (SELECT *, date_diff('second', AdjStartTime, AdjEndTime) AS secs
              FROM session_history)
        WHERE "Date" >= {FIRST} AND "Date" <= {AFTER}
        GROUP BY 1, 2, 3""",
    "call_buckets": f"""
        SELECT *, {daytime("ConvoTime_Mins")}, {daytime("SessionTime_Mins")}
        FROM (SELECT LocationCode AS CallCenterCode, OperatorID,
                     CAST(Handoff_Date AS TIMESTAMP) AS Handoff_Date,
                     {bucket_columns("ConvoTime", "ConvoTime_Mins", 60)},
                     {bucket_columns("SessionTime", "SessionTime_Mins", 60)}
              FROM calls
              WHERE Handoff_time >= {FIRST} AND Handoff_time < {AFTER}
                AND OperatorID IS NOT NULL
              GROUP BY 1, 2, 3)""",
    "call_days": f"SELECT * FROM call_buckets JOIN session_days USING ({KEYS})",
    "labor_days": f"""
        SELECT *, {daytime("LaborTime_Hours")}
        FROM (SELECT CallCenterCode, OperatorID, ShiftDate AS Handoff_Date,
                     MIN(OperatorName) AS OperatorName,
                     {bucket_columns("LaborTime_Secs", "LaborTime_Hours", 3600)}
              FROM labor
              WHERE ShiftDate >= {FIRST} AND ShiftDate < {AFTER} AND IsBenchmarkTask = 1
              GROUP BY 1, 2, 3)""",
    "login_days": f"""
        SELECT *, {daytime("ActivityTime_Mins")}
        FROM (SELECT CallCenterCode, OperatorID, Activity_Date AS Handoff_Date,
                     {bucket_columns(
                         "(LoginTime_Secs + TeamingTime_Secs - BreakTime_Secs)",
                         "ActivityTime_Mins", 60)}
              FROM activity
              WHERE Activity_Date >= {FIRST} AND Activity_Date < {AFTER}
              GROUP BY 1, 2, 3)""",
    "staff": f"""
        SELECT *, CAST(row_number() OVER (ORDER BY Employee_Name, OperatorID, ADP_ID) AS INTEGER)
                  AS Emp_RowNum
        FROM (SELECT DISTINCT EmployeeName AS Employee_Name, OperatorID,
                     CAST(ADP_ID AS INTEGER) AS ADP_ID, DefaultLocation, StaffType,
                     Language AS LanguageSkill, HireDate,
                     CAST(date_diff('month', HireDate, {AFTER}) AS INTEGER) AS MnthsTenure,
                     CAST(date_diff('hour', HireDate, {AFTER}) / 8766.0 AS DECIMAL(17,4))
                         AS YearTenure,
                     TermDate, Active
              FROM employees
              JOIN (SELECT DISTINCT OperatorID FROM call_days) ON ExternalID = OperatorID
              WHERE EmployeeName IS NOT NULL)""",
    "days": f"""
        SELECT {FIRST} AS StartDate, {AFTER} AS EndDate, c.Handoff_Date AS rptDate,
               COALESCE(DefaultLocation, c.CallCenterCode) AS HomeLocation, c.CallCenterCode,
               c.OperatorID, ADP_ID, Emp_RowNum,
               COALESCE(Employee_Name, OperatorName) AS employee_name, StaffType, LanguageSkill,
               CASE WHEN Active = 'False' THEN NULL ELSE HireDate END AS HireDate,
               CASE WHEN Active = 'False' THEN 0 ELSE MnthsTenure END AS MnthsTenure,
               BreakMins, TeamedMins, AvailableMins, {day_measures()}
        FROM call_days AS c
        LEFT JOIN login_days AS l USING ({KEYS})
        LEFT JOIN labor_days AS w USING ({KEYS})
        LEFT JOIN staff AS s ON s.OperatorID = c.OperatorID""",
    "labor_only": f"""
        SELECT * FROM days
        WHERE rptDate BETWEEN {FIRST} AND {AFTER} AND AllDays_12to12_LaborTime_Hours > 0""",
    "ratios": f"SELECT rptDate, {daily_ratios()} FROM labor_only GROUP BY rptDate",
    # Problem reports.
    "locations": """
        SELECT DISTINCT companyname, locationcode FROM caption_intervals
        WHERE companyname <> ''""",
    "sliced": """
        SELECT * FROM caption_calls
        WHERE Handoff_Time BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-25'""",
    "wanted_calls": """
        SELECT * FROM sliced
        WHERE (Answered = 1 OR Abandon = 1)
          AND locationcode IN (SELECT locationcode FROM locations
                               WHERE companyname = 'Company B')""",
    "all_company_calls": """
        SELECT * FROM sliced
        WHERE (Answered = 1 OR Abandon = 1)
          AND (locationcode = '' OR locationcode IN (SELECT locationcode FROM locations))""",
    "problems": """
        SELECT DISTINCT r.*, CategoryName
        FROM problem_reports AS r JOIN problem_categories USING (ProblemReportCategoryID)
        WHERE DateCreated >= TIMESTAMP '2024-01-05' AND DateCreated < TIMESTAMP '2024-01-25'
          AND ErrorCode = 'PR4000'""",
}


def match_sql(kind: str, calls: str) -> str:
    if kind == "xref":
        joined = (
            f"problems AS p JOIN caption_xref AS x ON x.SessionID = p.SessionID"
            f" JOIN {calls} AS c ON c.CallID = x.CallID"
        )
        session, assisted, dialed, label, caller = (
            "p.SessionID",
            "Caption_PhoneNumber_Clean",
            "Voice_PhoneNumber_Clean",
            "Call_Type_Label",
            "UserID_Caller",
        )
    else:
        joined = f"problems AS p JOIN {calls} AS c ON c.csOprSessionID = p.SessionID"
        session = assisted = dialed = label = caller = "''"
    return f"""
        SELECT DISTINCT TIMESTAMP '2024-01-05' AS StartDate, TIMESTAMP '2024-01-24' AS EndDate,
               csOprSessionID, DateCreated, ProblemReportID, {session} AS SessionID, OperatorID,
               locationcode, {assisted} AS AssistedUserTelephoneNumber,
               {dialed} AS DialedorReceivedTelephoneNumber, {label} AS CallType, CategoryName,
               ProblemReportData AS Notes, {caller} AS UserID_Caller, ErrorCode
        FROM {joined}"""


DAY_HEAD = [
    "StartDate", "EndDate", "rptDate", "HomeLocation", "CallCenterCode", "OperatorID", "ADP_ID",
    "Emp_RowNum", "employee_name", "StaffType", "LanguageSkill", "HireDate", "MnthsTenure",
]
SESSION_MINS = ["BreakMins", "TeamedMins", "AvailableMins"]

FINAL = {
    "scan_call_detail": "SELECT * FROM call_detail",
    "read_source_orders": "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders",
    "split30_all": "SELECT * FROM calls",
    "activity_time": "SELECT * FROM activity",
    "labor_time": "SELECT * FROM labor",
    "user_score": "SELECT * FROM user_scores",
    "terp_score": "SELECT * FROM terp_scores",
    "outbound_calls": "SELECT * FROM outbound",
    "agent_score": """
        SELECT AgentID, OutboundCalls, CAST(TerpUserScore AS BIGINT) AS TerpUserScore,
               PerfectScore, VIScore FROM agent_scores""",
    "css_report": """
        SELECT DATE '1998-04-01' AS StartDate, TIMESTAMP '1998-06-30' AS EndDate, AgentID,
               OutboundCalls, CAST(TerpUserScore AS BIGINT) AS TerpUserScore, PerfectScore,
               VIScore
        FROM agent_scores WHERE AgentID IS NOT NULL ORDER BY AgentID""",
    "css_report_closed_dates": """
        SELECT DATE '1998-04-01' AS StartDate, TIMESTAMP '1998-06-30' AS EndDate,
               OperatorID AS AgentID, CAST(calls AS BIGINT) AS OutboundCalls,
               CAST(points AS BIGINT) AS TerpUserScore, best AS PerfectScore,
               CAST(CAST(CAST(points AS DOUBLE) / CASE best WHEN 0 THEN 1 ELSE best END
                    AS DECIMAL(15,10)) AS DOUBLE) AS VIScore
        FROM closed_agents WHERE calls > 0 ORDER BY AgentID""",
    "session_minutes": f"SELECT {KEYS}, {doubles(SESSION_MINS)} FROM session_days",
    "bucket_calls": f"""
        SELECT {KEYS}, {doubles(measures("ConvoTime_Mins") + measures("SessionTime_Mins"))}
        FROM call_buckets""",
    "call_data": f"""
        SELECT {KEYS}, {doubles(
            SESSION_MINS + measures("ConvoTime_Mins") + measures("SessionTime_Mins"))}
        FROM call_days""",
    "labor_hours": f"""
        SELECT {KEYS}, OperatorName, {doubles(measures("LaborTime_Hours"))} FROM labor_days""",
    "login_minutes": f"""
        SELECT {KEYS}, {doubles(measures("ActivityTime_Mins"))} FROM login_days""",
    "operator_activity": f"""
        SELECT {KEYS}, OperatorName, {doubles(
            SESSION_MINS + [name for measure in MEASURES for name in measures(measure)])}
        FROM call_days LEFT JOIN login_days USING ({KEYS}) LEFT JOIN labor_days USING ({KEYS})""",
    "employee_data": """
        SELECT * EXCLUDE (YearTenure), CAST(YearTenure AS DOUBLE) AS YearTenure FROM staff""",
    "operator_day": f"""
        SELECT {", ".join(DAY_HEAD)}, {doubles(SESSION_MINS + day_measure_names())}
        FROM days""",
    "enterprise_ratio": f"SELECT rptDate, {doubles(RATIO_NAMES)} FROM ratios",
    "operator_performance": f"""
        SELECT {", ".join(DAY_HEAD)}, {doubles(SESSION_MINS + day_measure_names())},
               {shown_ratios()}
        FROM labor_only JOIN ratios USING (rptDate)
        ORDER BY CallCenterCode, rptDate""",
    "company_locations": "SELECT * FROM locations",
    "company_location_list": """
        SELECT companyname,
               string_agg('''' || locationcode || '''', ',' ORDER BY locationcode)
                   AS locationcodes
        FROM locations GROUP BY companyname""",
    "caption_slice": "SELECT * FROM sliced",
    "csc_session_match": match_sql("xref", "wanted_calls"),
    "csc_direct_match": match_sql("direct", "wanted_calls"),
    "csc_report": f"""
        {match_sql("xref", "wanted_calls")}
        UNION
        {match_sql("direct", "wanted_calls")}
        ORDER BY DateCreated""",
    "csc_report_all_companies": f"""
        {match_sql("xref", "all_company_calls")}
        UNION
        {match_sql("direct", "all_company_calls")}
        ORDER BY DateCreated""",
    "date_functions": """
        SELECT event_id, ts + INTERVAL 1 MONTH AS next_month, ts + INTERVAL 1 DAY AS next_day,
               CAST(date_trunc('month', ts) AS DATE) AS month_first,
               CAST(date_trunc('month', ts) - INTERVAL 1 MONTH AS DATE) AS prior_first,
               CAST(date_trunc('month', ts) - INTERVAL 1 DAY AS DATE) AS prior_last,
               CAST(CAST(ts AS DATE) AS TIMESTAMP) AS today,
               CAST(CAST(ts AS DATE) - 1 AS TIMESTAMP) AS yesterday,
               date_diff('second', since, ts) AS seconds,
               date_diff('hour', since, ts) AS hours, date_diff('month', since, ts) AS months,
               CAST(extract(hour FROM ts) AS INTEGER) AS hour_of_day,
               CAST(extract(dow FROM ts) + 1 AS INTEGER) AS day_of_week,
               CAST(extract(day FROM ts) AS INTEGER) AS day_of_month,
               CAST(extract(month FROM ts) AS INTEGER) AS month_of_year
        FROM (SELECT *, TIMESTAMP '2023-11-30 23:59:59.5' AS since FROM events)""",
    "month_windows": """
        SELECT o_orderkey, first - INTERVAL 1 MONTH AS overall_start,
               first + INTERVAL 1 MONTH AS overall_stop, first AS current_start,
               first + INTERVAL 1 MONTH AS current_stop, first - INTERVAL 1 MONTH AS prior_start,
               first AS prior_stop,
               first + INTERVAL 1 MONTH - INTERVAL 1 DAY AS current_last,
               first - INTERVAL 1 DAY AS prior_last,
               CAST(first - INTERVAL 1 MONTH AS DATE) AS report_start,
               o_orderdate + INTERVAL 1 MONTH AS report_end
        FROM (SELECT o_orderkey, o_orderdate,
                     CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS first FROM orders)""",
    "resolve_range": """
        SELECT event_id,
               CAST(date_trunc('month', today - INTERVAL 1 DAY) AS TIMESTAMP) AS to_date_start,
               today AS to_date_stop,
               today - to_days(CAST(event_id % 10 AS INTEGER)) AS ago_start,
               today - to_days(CAST(event_id % 10 AS INTEGER)) + INTERVAL 1 DAY AS ago_stop,
               ts AS given_start, ts + INTERVAL 1 DAY AS given_stop
        FROM (SELECT *, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS today FROM events)""",
    "csc_range": """
        SELECT o_orderkey,
               CASE WHEN extract(day FROM o_orderdate) = 1
                    THEN CAST(o_orderdate - INTERVAL 1 MONTH AS DATE)
                    ELSE CAST(date_trunc('month', o_orderdate) AS DATE) END AS first_day,
               CAST(o_orderdate - INTERVAL 1 DAY AS DATE) AS last_day
        FROM orders""",
}


LOWERED = {
    "operator_performance": ["HomeLocation", "CallCenterCode"],
    "csc_report": ["csOprSessionID", "SessionID", "locationcode", "ErrorCode"],
}
# Other ways to the same rows.
SAME = {
    "read_source_catalog": "read_source_orders",
    "split30_inserted": "split30_all",
    "caption_slice_by_day": "caption_slice",
    "operator_performance_stored": "operator_performance",
    "operator_performance_sink": "operator_performance",
    "csc_session_match_bucketed": "csc_session_match",
}
FINAL |= {new: FINAL[old] for new, old in SAME.items()} | {
    f"{name}_any_case": "SELECT * REPLACE ("
    + ", ".join(f"lower({c}) AS {c}" for c in columns)
    + f") FROM ({FINAL[name]})"
    for name, columns in LOWERED.items()
}
FLAGS = [
    "isCoreHours", "isNonCoreHours", "is6to12Hours", "is12to18Hours", "isWeekdayHours",
    "isSaturdayHours", "isSundayHours",
]
FINAL["activity_in_shift"] = f"""
    SELECT a.*, ShiftDate, Interval_Begin, ShiftStart, ShiftEnd, OperatorName, LaborTime_Secs,
           TaskType, IsBenchmarkTask, l.CallCenterCode AS Shift_CallCenterCode,
           {", ".join(f"l.{name} AS Shift_{name}" for name in FLAGS)}
    FROM activity AS a LEFT JOIN labor AS l
      ON a.OperatorID = l.OperatorID AND ShiftStart <= Activity_Begin_Time
     AND Activity_Begin_Time < ShiftEnd"""
FINAL["half_hour_calls"] = """
    SELECT CallID, slot AS Interval_Time,
           CAST(slot = first_slot AS INTEGER) AS First_Interval,
           CAST(slot = last_slot AS INTEGER) AS Last_Interval,
           CASE WHEN SessionStart <= SessionEnd THEN greatest(0, date_diff('microsecond',
               greatest(SessionStart, slot), least(SessionEnd, slot + INTERVAL 30 MINUTE)))
               / 1e6 END AS SessionTime,
           CASE WHEN ConvoStart <= ConvoEnd THEN greatest(0, date_diff('microsecond',
               greatest(ConvoStart, slot), least(ConvoEnd, slot + INTERVAL 30 MINUTE)))
               / 1e6 END AS ConvoTime
    FROM (
        SELECT *, unnest(generate_series(first_slot, last_slot, INTERVAL 30 MINUTE)) AS slot
        FROM (
            SELECT *, time_bucket(INTERVAL 30 MINUTE, started) AS first_slot,
                   time_bucket(INTERVAL 30 MINUTE,
                       greatest(started, ended - INTERVAL 1 MICROSECOND)) AS last_slot
            FROM (
                SELECT *, SessionStart AS started,
                       CASE WHEN ConvoStart <= ConvoEnd THEN greatest(SessionEnd, ConvoEnd)
                            ELSE SessionEnd END AS ended
                FROM raw_calls)))"""


def oracle_sql() -> dict[str, str]:
    """Each final query with the steps it uses, directly or through other steps."""
    found = {name: _with_steps(sql) for name, sql in FINAL.items()}
    found["operator_performance_adjusted"] = _five_hours_later(found["operator_performance"])
    return found


def _five_hours_later(sql: str) -> str:
    """The report with calls counted five hours after their hand-off."""
    day, time = "CAST(Handoff_Date AS TIMESTAMP) AS Handoff_Date", "WHERE Handoff_time >="
    assert sql.count(day) == sql.count(time) == 1
    later = "(Handoff_time + INTERVAL 5 HOUR)"
    sql = sql.replace(day, f"CAST(CAST({later} AS DATE) AS TIMESTAMP) AS Handoff_Date")
    return sql.replace(
        f"{time} {FIRST} AND Handoff_time <", f"WHERE {later} >= {FIRST} AND {later} <"
    )


def _with_steps(sql: str) -> str:
    names = list(STEPS)
    used: set[str] = set()
    texts = [sql]
    while texts:
        words = set(texts.pop().replace("(", " ").replace(")", " ").replace(",", " ").split())
        for name in names:
            if name in words and name not in used:
                used.add(name)
                texts.append(STEPS[name])
    if not used:
        return sql.strip()
    ctes = ",\n".join(f"{name} AS ({STEPS[name]})" for name in names if name in used)
    return f"WITH {ctes}\n{sql.strip()}"
