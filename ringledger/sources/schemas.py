"""Columns and types each source table must offer.

Fixed values: the names are those the reports read and return.
"""

from __future__ import annotations

INT = "int"
TEXT = "string"
TIME = "timestamp_ntz"
SECONDS = "int"
FLAG = "int"


def _each(names: str, kind: str) -> dict[str, str]:
    return dict.fromkeys(names.split(), kind)


CALL_DETAIL = {
    "OperatorID": INT,
    "UserID_Caller": INT,
    "timeWait": TIME,
    "Outbound": FLAG,
    "isReport": FLAG,
}

# Columns the three half-hour call tables have in common.
CALL_COMMON = {
    "Interval_Time": TIME,
    "CallID": TEXT,
    "First_Interval": FLAG,
    "Last_Interval": FLAG,
    **_each("SessionID ConvoID RLSA_ConvoID", TEXT),
    "Teaming": FLAG,
    **_each("csOprSessionID oclOprSessionID", TEXT),
    "OperatorID": INT,
    **_each("LocationCode CenterID", TEXT),
    "Handoff_time": TIME,
    **_each("Abandon LostAbandon Answered Incoming Outbound", FLAG),
    **_each("isCoreHours isNonCoreHours is6to12Hours is12to18Hours", FLAG),
    **_each("isWeekdayHours isSaturdayHours isSundayHours", FLAG),
    **_each("isEnglishCall IsSpanishCall", FLAG),
    **_each("AbandonTime AnsweredTime VI_AnswerTime csoprAcceptTime", SECONDS),
    **_each("Branding LANGUAGE Call_Type", TEXT),
    "UserID_Caller": INT,
    **_each("Voice_PhoneNumber DeviceID", TEXT),
}

# Session and conversation columns of the relay tables.
CALL_SESSION = {
    **_each("SessionStart SessionStart_RL ConvoStart ConvoEnd", TIME),
    **_each("SessionEnd_RL SessionEnd", TIME),
    **_each("SessionTime_Total SessionTime ConvoTime", SECONDS),
    "RLSA_ConvoTime": "decimal(12,1)",
    "BillableTime": "decimal(12,1)",
    **_each("PhoneNumber RLSA_Disp RLSA_Disp_Reason", TEXT),
}

RELAY_CALLS = {**CALL_COMMON, **CALL_SESSION}

REMOTE_CALLS = {
    **CALL_COMMON,
    **_each("ConvoStart ConvoStart_RL ConvoEnd ConvoEnd_RL", TIME),
    **_each("ConvoTime r_ConvoTime", SECONDS),
    "Video_PhoneNumber": TEXT,
}

SESSION_HISTORY = {
    "OperatorID": INT,
    "CallCenterCode": TEXT,
    "Date": TIME,
    "AdjStartTime": TIME,
    "AdjEndTime": TIME,
    "EntryType": INT,
    **_each("LoginTime TeamingTime BreakTime", SECONDS),
}

SCHEDULE = {
    "Date": TIME,
    "HlfHrStart": TIME,
    "adjShiftStart": TIME,
    "adjShiftEnd": TIME,
    "Emp_ID": INT,
    **_each("Employee_Name Station_Name TaskName", TEXT),
    "LaborTime": SECONDS,
}

EMPLOYEES = {
    "ExternalID": INT,
    **_each("EmployeeName ADP_ID DefaultLocation StaffType Language", TEXT),
    "HireDate": TIME,
    "TermDate": TIME,
    "Active": TEXT,
}

PROBLEM_REPORTS = {
    "ProblemReportID": INT,
    "SessionID": TEXT,
    "ProblemReportCategoryID": INT,
    **_each("ProblemReportData ErrorCode", TEXT),
    "DateCreated": TIME,
}

PROBLEM_CATEGORIES = {
    "ProblemReportCategoryID": INT,
    "CategoryName": TEXT,
}

CAPTION_CALLS = {
    "CallID": TEXT,
    "csOprSessionID": TEXT,
    "Handoff_Time": TIME,
    **_each("OperatorID locationcode", TEXT),
    **_each("Caption_PhoneNumber_Clean Voice_PhoneNumber_Clean", TEXT),
    **_each("Call_Type_Label UserID_Caller", TEXT),
    **_each("Answered Abandon", FLAG),
}

CAPTION_XREF = {"CallID": TEXT, "SessionID": TEXT}

CAPTION_INTERVALS = {"companyname": TEXT, "locationcode": TEXT}

# Calls before they are cut into half hours.
RAW_CALLS = {
    "CallID": TEXT,
    **_each("SessionStart SessionEnd ConvoStart ConvoEnd", TIME),
}
