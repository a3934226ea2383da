"""Hour-of-day and weekday flags, and the eight time buckets built on them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MINUTES = "decimal(17,4)"
LONG_MINUTES = "decimal(18,4)"

# The flag columns that each bucket requires to be 1.
BUCKETS = {
    "AllDays_12to12": (),
    "MtoF_NonCore": ("isWeekdayHours", "isNonCoreHours"),
    "MtoF_6to12": ("isWeekdayHours", "is6to12Hours"),
    "MtoF_12to6": ("isWeekdayHours", "is12to18Hours"),
    "Sat_12to12": ("isSaturdayHours",),
    "Sat_6to6": ("isSaturdayHours", "isCoreHours"),
    "Sun_12to12": ("isSundayHours",),
    "Sun_6to6": ("isSundayHours", "isCoreHours"),
}

# Name endings of the four measures.
LABOR = "LaborTime_Hours"
CONVO = "ConvoTime_Mins"
SESSION = "SessionTime_Mins"
ACTIVITY = "ActivityTime_Mins"


def measure_name(bucket: str, measure: str) -> str:
    """Report column for a bucket and measure.

    Saturday labour is named ``..._Mins`` in the report although it holds hours.
    Report consumers rely on the name, so it stays.
    """
    if (bucket, measure) == ("Sat_12to12", LABOR):
        return "Sat_12to12_LaborTime_Mins"
    return f"{bucket}_{measure}"


def time_flag_rules(moment: str) -> dict[str, str]:
    """Seven 0/1 columns of a time column, as SQL by name. A null time gives all zeros.

    ``dayofweek`` is 1 on Sunday and 7 on Saturday in every locale.
    """
    hour, day = f"hour(`{moment}`)", f"dayofweek(`{moment}`)"
    rules = {
        "isCoreHours": f"{hour} between 6 and 17",
        "isNonCoreHours": f"{hour} not between 6 and 17",
        "is6to12Hours": f"{hour} between 6 and 11",
        "is12to18Hours": f"{hour} between 12 and 17",
        "isWeekdayHours": f"{day} between 2 and 6",
        "isSaturdayHours": f"{day} = 7",
        "isSundayHours": f"{day} = 1",
    }
    return {name: flag(rule) for name, rule in rules.items()}


def time_flags(moment: str) -> list[str]:
    return [f"{sql} as {name}" for name, sql in time_flag_rules(moment).items()]


def flag(condition: str) -> str:
    """SQL for 1 where the condition holds, 0 where it is false or unknown."""
    return f"if({condition}, 1, 0)"


def bucket_sums(amount: str, measure: str) -> list[Column]:
    """One conditional sum of whole seconds per bucket, over the SQL ``amount``.

    Rows outside a bucket add 0; rows inside add the amount, so an unknown amount
    is skipped. Sums stay integers here: the unit change happens once per group.
    """
    sums = []
    for bucket, flags in BUCKETS.items():
        inside = amount
        if flags:
            condition = " and ".join(f"{name} = 1" for name in flags)
            inside = f"if({condition}, {amount}, 0)"
        sums.append(F.expr(f"sum({inside}) as {measure_name(bucket, measure)}"))
    return sums


def in_units(measure: str, seconds_per_unit: str) -> list[str]:
    """SQL to convert a measure's bucket sums and add the weekday 6-to-6 total.

    ``seconds_per_unit`` is a decimal literal, so the quotient is exact to six
    places before it is rounded to four.
    """
    converted = {
        bucket: f"cast({measure_name(bucket, measure)} / {seconds_per_unit} as {MINUTES})"
        for bucket in BUCKETS
    }
    morning, afternoon = or_zero(converted["MtoF_6to12"]), or_zero(converted["MtoF_12to6"])
    daytime = f"cast({morning} + {afternoon} as {LONG_MINUTES})"
    return [
        *[f"{sql} as {measure_name(b, measure)}" for b, sql in converted.items()],
        f"{daytime} as {measure_name('MtoF_6to6', measure)}",
    ]


def or_zero(amount: str) -> str:
    return f"coalesce({amount}, 0)"
