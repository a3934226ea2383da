"""Spans of time: the shift that covers an activity, and calls cut into half hours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringledger.functions.dates import as_time, midnight

HALF_HOUR = 30
_CELL, _BEGIN, _END = "_cell", "_begin", "_end"


def covering_shifts(
    activity: DataFrame, shifts: DataFrame, key: str = "OperatorID", cell_hours: int = 24
) -> DataFrame:
    """Each activity beside the shifts of its operator that it begins in.

    ``activity`` is in the shape of ``views.activity_time`` and ``shifts`` in that of
    ``views.labor_time``. A shift covers the times from its start up to, not including, its
    end. An activity in several shifts gets a row for each; one in none, or without an
    operator or a time, stays with the shift columns null. Shift columns that the activity
    has too get the prefix ``Shift_``. A shift without a start, or that ends no later than
    it starts, covers nothing.

    Time is cut into cells of ``cell_hours``. An activity lies in one cell and a shift is
    repeated for each that it touches, so operator and cell are an equi-join; the exact
    bounds are tested on what meets there. A shift that covers an activity touches its
    cell once, so no pair comes twice.
    """
    taken = {c: f"Shift_{c}" if c in activity.columns else c for c in shifts.columns if c != key}
    start, stop = as_time(F.col("ShiftStart")), as_time(F.col("ShiftEnd"))
    last = stop - F.expr("interval 1 microsecond")
    cells = F.sequence(_cell(start, cell_hours), _cell(last, cell_hours))
    spread = shifts.where(start < stop).select(
        F.col(key).alias("_key"),
        *(F.col(c).alias(name) for c, name in taken.items()),
        start.alias(_BEGIN),
        stop.alias(_END),
        F.explode(cells).alias("_shift_cell"),
    )
    moment = F.col("Activity_Begin_Time")
    placed = activity.withColumn(_CELL, _cell(as_time(moment), cell_hours))
    met = (
        (F.col(key) == F.col("_key"))
        & (F.col(_CELL) == F.col("_shift_cell"))
        & (F.col(_BEGIN) <= moment)
        & (moment < F.col(_END))
    )
    return placed.join(spread, met, "left").select(*activity.columns, *taken.values())


def _cell(moment: Column, hours: int) -> Column:
    """Number of the cell that a time lies in, whatever the session's time zone."""
    days = F.datediff(moment.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    return F.floor((days * 24 + F.hour(moment)) / F.lit(hours)).cast("bigint")


def split_half_hours(
    calls: DataFrame, spans: dict[str, tuple[str, str]], minutes: int = HALF_HOUR
) -> DataFrame:
    """A row for each half hour that a call touches, with its seconds there.

    ``spans`` names a start and an end column for each column of seconds to add. A call
    reaches from the earliest start to the latest end of its spans; a span counts in a half
    hour with the time it has there, to the microsecond, so a call's rows add up to the
    length of its spans. ``Interval_Time`` is the start of the half hour, and
    ``First_Interval`` and ``Last_Interval`` are 1 in the call's first and last.

    A call that ends on the half hour doesn't touch the next; one without length has one
    row. A span with a null end or start, or one that ends before it starts, has null
    seconds and doesn't count for the call's reach; a call with no other span has one row,
    both flags 1 and the interval null. Columns named like new ones are replaced.
    """
    if minutes <= 0 or 1440 % minutes:
        raise ValueError("a day must be a whole number of intervals")
    step = F.make_dt_interval(mins=F.lit(minutes))
    new = ["Interval_Time", "First_Interval", "Last_Interval", *spans]
    sound = {n: as_time(F.col(a)) <= as_time(F.col(b)) for n, (a, b) in spans.items()}
    starts = [F.when(sound[n], as_time(F.col(a))) for n, (a, _) in spans.items()]
    ends = [F.when(sound[n], as_time(F.col(b))) for n, (_, b) in spans.items()]
    begin = starts[0] if len(starts) == 1 else F.least(*starts)
    end = ends[0] if len(ends) == 1 else F.greatest(*ends)
    # The last interval is that of the last moment inside; a call without length keeps one.
    inside = F.greatest(begin, end - F.expr("interval 1 microsecond"))
    grid = F.sequence(_floor(begin, minutes), _floor(inside, minutes), step)
    rows = calls.withColumn("_grid", grid).select(
        *(c for c in calls.columns),
        F.size("_grid").alias("_many"),
        F.posexplode_outer("_grid").alias("_place", "_from"),
    )
    seconds = []
    for name, (a, b) in spans.items():
        first = F.greatest(as_time(F.col(a)), F.col("_from"))
        last = F.least(as_time(F.col(b)), F.col("_from") + step)
        length = F.greatest(_micros(last) - _micros(first), F.lit(0)) / F.lit(1_000_000).cast("decimal(8,0)")
        seconds.append(F.when(sound[name], length.cast("decimal(18,6)")).alias(name))
    one = F.col("_from").isNull()
    return rows.select(
        *(c for c in calls.columns if c not in new),
        F.col("_from").alias("Interval_Time"),
        F.when(one | (F.col("_place") == 0), 1).otherwise(0).alias("First_Interval"),
        F.when(one | (F.col("_place") == F.col("_many") - 1), 1).otherwise(0).alias("Last_Interval"),
        *seconds,
    )


def _floor(moment: Column, minutes: int) -> Column:
    into = F.hour(moment) * 60 + F.minute(moment)
    return midnight(moment) + F.make_dt_interval(mins=into - into % F.lit(minutes))


def _micros(moment: Column) -> Column:
    """Microseconds since 1970 on the clock the time is read from."""
    days = F.datediff(moment.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    within = F.extract(F.lit("SECOND"), moment) * 1_000_000
    return days * 86_400_000_000 + (F.hour(moment) * 3600 + F.minute(moment) * 60).cast("bigint") * 1_000_000 + within.cast("bigint")
