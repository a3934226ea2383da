"""Normalised views over the session, schedule and half-hour call tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ringledger.functions.text import alike
from ringledger.functions.timeflags import flag, time_flags
from ringledger.sources import schemas

# Scheduled tasks that count as labour. An unnamed task is relay work.
BENCHMARK_TASKS = [
    "VRS",
    "Bench Time",
    "Corporate Events",
    "Professional Development",
    "ISAS Rating",
    "Management",
]
DEFAULT_TASK = "VRS"

# The tag of each call source.
VRS, VRI, RELAY = "VRS", "VRI", "ConvoRelay"

# The last columns of the call view, in their order. Before them come the tag,
# the day, and the other columns in the order of the two schemas.
LAST_CALL_COLUMNS = [
    "Branding",
    "LANGUAGE",
    "Call_Type",
    "UserID_Caller",
    "UserID_Caller_TDN",
    "Voice_PhoneNumber",
    "PhoneNumber",
    "DeviceID",
    "RLSA_Disp",
    "RLSA_Disp_Reason",
]
CALL_COLUMNS = [
    "CallData_Type",
    "Handoff_Date",
    *(name for name in schemas.RELAY_CALLS if name not in LAST_CALL_COLUMNS),
    *LAST_CALL_COLUMNS,
]


def activity_time(sessions: DataFrame) -> DataFrame:
    """Logged-in time per session entry, flagged by the entry's start time."""
    return sessions.selectExpr(
        "OperatorID",
        "CallCenterCode",
        "Date as Activity_Date",
        "AdjStartTime as Activity_Begin_Time",
        "AdjEndTime as Activity_End_Time",
        "LoginTime as LoginTime_Secs",
        "TeamingTime as TeamingTime_Secs",
        "BreakTime as BreakTime_Secs",
        *time_flags("AdjStartTime"),
    )


def labor_time(schedule: DataFrame) -> DataFrame:
    """Scheduled time per half hour, flagged by shift start and by kind of task."""
    tasks = ", ".join(f"'{task}'" for task in BENCHMARK_TASKS)
    counts = flag(f"coalesce(TaskName, '{DEFAULT_TASK}') in ({tasks})")
    return schedule.selectExpr(
        "Date as ShiftDate",
        "HlfHrStart as Interval_Begin",
        "adjShiftStart as ShiftStart",
        "adjShiftEnd as ShiftEnd",
        "Emp_ID as OperatorID",
        "Employee_Name as OperatorName",
        "Station_Name as CallCenterCode",
        "LaborTime as LaborTime_Secs",
        "TaskName as TaskType",
        f"{counts} as IsBenchmarkTask",
        *time_flags("adjShiftStart"),
    )


def split30_all(
    vrs: DataFrame, vri: DataFrame, relay: DataFrame, further: tuple[str, ...] = ()
) -> DataFrame:
    """Half-hour calls of all three sources in one 55-column shape, in ``CALL_COLUMNS`` order.

    ``further`` names columns beyond those, which all three sources must have.

    Only columns that a consumer selects are read: pruning and filters pass
    through the union to each scan.
    """
    caller = "cast(UserID_Caller as string)"
    # Anonymous relay callers share ids below 1, so their number tells them apart.
    relay_caller = (
        "if(UserID_Caller < 1 and coalesce(PhoneNumber, '') != '', "
        f"concat('tdn_', PhoneNumber), {caller})"
    )
    # A remote-interpreting call has no session of its own: its conversation on the
    # customer's side stands in for one.
    remote = {
        "SessionStart": "ConvoStart",
        "SessionStart_RL": "ConvoStart_RL",
        "ConvoStart": "ConvoStart_RL",
        "ConvoEnd": "ConvoEnd_RL",
        "SessionEnd_RL": "ConvoEnd_RL",
        "SessionEnd": "ConvoEnd",
        "SessionTime_Total": "ConvoTime",
        "SessionTime": "r_ConvoTime",
        "ConvoTime": "r_ConvoTime",
        "RLSA_ConvoTime": f"cast(null as {schemas.CALL_SESSION['RLSA_ConvoTime']})",
        "BillableTime": f"cast(null as {schemas.CALL_SESSION['BillableTime']})",
        "PhoneNumber": "Video_PhoneNumber",
        "RLSA_Disp": "'C'",
        "RLSA_Disp_Reason": "'VRI'",
    }
    first, second, third = alike(
        [
            _tagged(vrs, VRS, caller, {}, further),
            _tagged(vri, VRI, caller, remote, further),
            _tagged(relay, RELAY, relay_caller, {}, further),
        ]
    )
    return first.unionByName(second).unionByName(third)


def _tagged(
    calls: DataFrame,
    source: str,
    caller: str,
    replaced: dict[str, str],
    further: tuple[str, ...],
) -> DataFrame:
    columns = {
        "CallData_Type": f"'{source}'",
        "Handoff_Date": "cast(Handoff_time as date)",
        "UserID_Caller_TDN": caller,
    } | replaced
    return calls.selectExpr(
        *[f"{columns.get(name, name)} as {name}" for name in CALL_COLUMNS], *further
    )
