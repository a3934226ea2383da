"""Source-shaped views of the shared test tables.

Each function takes the session and the folder of the parquet test tables and
returns a DataFrame in the shape of one source table. The mapping is described in
``FIXTURES.md``. All rows of a test table take part: each source takes all of them, but
for the three call tables, among which they are divided by their kind.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringledger.functions.timeflags import flag, time_flag_rules
from ringledger.sources import schemas

# Columns in use of each test table.
TEST_TABLES = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "lineitem": "l_orderkey bigint, l_suppkey bigint, l_returnflag string, l_linestatus string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "nation": "n_nationkey int",
    "region": "r_regionkey int, r_name string",
}

OPERATOR = "user_id"
CENTER = "concat('C', user_id % 5)"
NUMBER = "cast(event_id as string)"
VALUE = "floor(value)"
PHONE = f"case event_id % 3 when 0 then '' when 2 then concat('555', {NUMBER}) end"
MIDNIGHT = "cast(cast(ts as date) as timestamp_ntz)"
HALF_HOUR = f"{MIDNIGHT} + make_dt_interval(0, hour(ts), minute(ts) - minute(ts) % 30)"
WHOLE_SECOND = f"{MIDNIGHT} + make_dt_interval(0, hour(ts), minute(ts), second(ts))"
ANSWERED = flag("event_id % 5 = 0")
ABANDON = flag("event_id % 5 = 1")
LATE_SESSION = "concat('S', (event_id + 4) div 8)"

# Kinds of event that stand for two kinds of call; all others stand for relay calls.
VRS_EVENTS, VRI_EVENTS = ("click", "signup"), ("view", "error")

# The task name for each remainder of the event id by 9; 2 has none.
TASKS = {
    0: "VRS",
    1: "VRI",
    3: "Bench Time",
    4: "Corporate Events",
    5: "Professional Development",
    6: "ISAS Rating",
    7: "Management",
    8: "Lunch",
}

# The columns that the three call tables share. Those without a stand-in are constant.
SHARED_CALL = {
    "Interval_Time": HALF_HOUR,
    "CallID": NUMBER,
    "First_Interval": "1",
    "Last_Interval": "0",
    "SessionID": f"concat('s', {NUMBER})",
    "ConvoID": f"concat('c', {NUMBER})",
    "RLSA_ConvoID": f"concat('r', {NUMBER})",
    "Teaming": "0",
    "csOprSessionID": LATE_SESSION,
    "oclOprSessionID": f"concat('o', {NUMBER})",
    "OperatorID": OPERATOR,
    "LocationCode": CENTER,
    "CenterID": "'Center'",
    "Handoff_time": "ts",
    "Abandon": ABANDON,
    "LostAbandon": "0",
    "Answered": ANSWERED,
    "Incoming": "1",
    "Outbound": "0",
    **time_flag_rules("ts"),
    "isEnglishCall": "1",
    "IsSpanishCall": "0",
    "AbandonTime": "null",
    "AnsweredTime": "5",
    "VI_AnswerTime": "6",
    "csoprAcceptTime": "7",
    "Branding": "'Brand'",
    "LANGUAGE": "'EN'",
    "Call_Type": "'Relay'",
    "UserID_Caller": "user_id - 5",
    "Voice_PhoneNumber": f"concat('556', {NUMBER})",
    "DeviceID": f"concat('d', {NUMBER})",
}

RELAY_CALL = {
    **SHARED_CALL,
    "SessionStart": "ts",
    "SessionStart_RL": "ts + interval 1 second",
    "ConvoStart": "ts + interval 2 second",
    "ConvoEnd": "ts + interval 3 second",
    "SessionEnd_RL": "ts + interval 4 second",
    "SessionEnd": "ts + interval 5 second",
    "SessionTime_Total": f"{VALUE} + event_id % 60 + 1",
    "SessionTime": f"{VALUE} + event_id % 60",
    "ConvoTime": VALUE,
    "RLSA_ConvoTime": "1.5",
    "BillableTime": VALUE,
    "PhoneNumber": PHONE,
    "RLSA_Disp": "'B'",
    "RLSA_Disp_Reason": "'Reason'",
}

REMOTE_CALL = {
    **SHARED_CALL,
    "ConvoStart": "ts",
    "ConvoStart_RL": "ts + interval 1 second",
    "ConvoEnd": "ts + interval 4 second",
    "ConvoEnd_RL": "ts + interval 3 second",
    "ConvoTime": f"{VALUE} + event_id % 60",
    "r_ConvoTime": VALUE,
    "Video_PhoneNumber": PHONE,
}


def call_detail(spark: SparkSession, folder: str) -> DataFrame:
    lines = test_table(spark, folder, "lineitem")
    orders = test_table(spark, folder, "orders")
    columns = {
        "OperatorID": "l_suppkey",
        "UserID_Caller": "o_custkey",
        "timeWait": "o_orderdate",
        "Outbound": flag("l_returnflag = 'N'"),
        "isReport": flag("l_linestatus = 'O'"),
    }
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    return _shaped(joined, schemas.CALL_DETAIL, columns)


def calls_vrs(spark: SparkSession, folder: str) -> DataFrame:
    return _shaped(_events(spark, folder, *VRS_EVENTS), schemas.RELAY_CALLS, RELAY_CALL)


def calls_vri(spark: SparkSession, folder: str) -> DataFrame:
    return _shaped(_events(spark, folder, *VRI_EVENTS), schemas.REMOTE_CALLS, REMOTE_CALL)


def calls_relay(spark: SparkSession, folder: str) -> DataFrame:
    events = test_table(spark, folder, "events")
    others = F.coalesce(~events.event_type.isin(*VRS_EVENTS, *VRI_EVENTS), F.lit(True))
    return _shaped(events.where(others), schemas.RELAY_CALLS, RELAY_CALL)


def raw_calls(spark: SparkSession, folder: str) -> DataFrame:
    """Calls of some seconds to hours; the conversation of a short one has no length, or less."""
    columns = {
        "CallID": NUMBER,
        "SessionStart": "ts",
        "SessionEnd": f"ts + make_dt_interval(0, 0, 0, {VALUE} * 30)",
        "ConvoStart": "if(event_id % 17 = 0, null, ts + interval 20 second)",
        "ConvoEnd": f"ts + make_dt_interval(0, 0, 0, {VALUE} * 30 - 5)",
    }
    return _shaped(test_table(spark, folder, "events"), schemas.RAW_CALLS, columns)


def session_history(spark: SparkSession, folder: str) -> DataFrame:
    columns = {
        "OperatorID": OPERATOR,
        "CallCenterCode": CENTER,
        "Date": MIDNIGHT,
        "AdjStartTime": WHOLE_SECOND,
        "AdjEndTime": f"{WHOLE_SECOND} + make_dt_interval(0, 0, 0, {VALUE})",
        "EntryType": "event_id % 7",
        "LoginTime": f"{VALUE} * 3",
        "TeamingTime": "event_id % 100",
        "BreakTime": "if(event_id % 10 = 0, null, event_id % 30)",
    }
    events = test_table(spark, folder, "events")
    return _shaped(events, schemas.SESSION_HISTORY, columns)


def schedule(spark: SparkSession, folder: str) -> DataFrame:
    tasks = " ".join(f"when {n} then '{name}'" for n, name in TASKS.items())
    columns = {
        "Date": MIDNIGHT,
        "HlfHrStart": HALF_HOUR,
        "adjShiftStart": HALF_HOUR,
        "adjShiftEnd": f"{HALF_HOUR} + make_dt_interval(0, 0, 30)",
        "Emp_ID": OPERATOR,
        "Employee_Name": f"concat('Sched ', {OPERATOR})",
        "Station_Name": CENTER,
        "TaskName": f"case event_id % 9 {tasks} end",
        "LaborTime": "1800",
    }
    return _shaped(test_table(spark, folder, "events"), schemas.SCHEDULE, columns)


def employees(spark: SparkSession, folder: str) -> DataFrame:
    columns = {
        "ExternalID": "s_suppkey",
        "EmployeeName": "s_name",
        "ADP_ID": "s_suppkey + 1000",
        "DefaultLocation": "concat('C', s_nationkey % 5)",
        "StaffType": "if(s_suppkey % 2 = 0, 'Full', 'Part')",
        "Language": "if(s_suppkey % 3 = 0, 'ES', 'EN')",
        "HireDate": "date_add(date'2010-01-01', cast(s_suppkey * 37 as int))",
        "TermDate": "null",
        "Active": "if(s_suppkey % 7 = 0, 'False', 'True')",
    }
    return _shaped(test_table(spark, folder, "supplier"), schemas.EMPLOYEES, columns)


def problem_reports(spark: SparkSession, folder: str) -> DataFrame:
    columns = {
        "ProblemReportID": "event_id",
        "SessionID": "concat('S', event_id div 8)",
        "ProblemReportCategoryID": "event_id % 4",
        "ProblemReportData": "props",
        "ErrorCode": "if(event_id % 3 = 0, 'PR4000', 'PR1000')",
        "DateCreated": "ts",
    }
    return _shaped(test_table(spark, folder, "events"), schemas.PROBLEM_REPORTS, columns)


def problem_categories(spark: SparkSession, folder: str) -> DataFrame:
    columns = {"ProblemReportCategoryID": "r_regionkey", "CategoryName": "r_name"}
    return _shaped(test_table(spark, folder, "region"), schemas.PROBLEM_CATEGORIES, columns)


def caption_calls(spark: SparkSession, folder: str) -> DataFrame:
    columns = {
        "CallID": NUMBER,
        "csOprSessionID": LATE_SESSION,
        "Handoff_Time": "ts",
        "OperatorID": OPERATOR,
        "locationcode": "case when event_id % 11 = 0 then '' when event_id % 13 = 0 then null "
        f"else {CENTER} end",
        "Caption_PhoneNumber_Clean": f"concat('555', {NUMBER})",
        "Voice_PhoneNumber_Clean": f"concat('556', {NUMBER})",
        "Call_Type_Label": "event_type",
        "UserID_Caller": "user_id",
        "Answered": ANSWERED,
        "Abandon": ABANDON,
    }
    return _shaped(test_table(spark, folder, "events"), schemas.CAPTION_CALLS, columns)


def caption_xref(spark: SparkSession, folder: str) -> DataFrame:
    columns = {"CallID": NUMBER, "SessionID": "concat('S', event_id div 8)"}
    return _shaped(test_table(spark, folder, "events"), schemas.CAPTION_XREF, columns)


def caption_intervals(spark: SparkSession, folder: str) -> DataFrame:
    columns = {
        "companyname": "case when n_nationkey = 24 then '' "
        "when n_nationkey % 5 = 0 then 'Company A' "
        "when n_nationkey % 5 <= 2 then 'Company B' else 'Company C' end",
        "locationcode": "concat('C', n_nationkey % 5)",
    }
    return _shaped(test_table(spark, folder, "nation"), schemas.CAPTION_INTERVALS, columns)


def test_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A test table, read with a declared schema so that no job infers one."""
    return spark.read.schema(TEST_TABLES[name]).parquet(f"{folder}/{name}.parquet")


def _events(spark: SparkSession, folder: str, *kinds: str) -> DataFrame:
    events = test_table(spark, folder, "events")
    return events.where(events.event_type.isin(*kinds))


def _shaped(df: DataFrame, schema: dict[str, str], columns: dict[str, str]) -> DataFrame:
    """Select a SQL expression for each column of the schema, in its declared type."""
    return df.selectExpr(
        *[f"cast({columns[name]} as {kind}) as {name}" for name, kind in schema.items()]
    )
