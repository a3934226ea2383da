"""Monthly caller-retention report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringledger.functions.dates import When
from ringledger.operators.retention import calls_in, countable, score, score_sums, with_ratio
from ringledger.operators.windows import MonthWindows, Window, month_windows


def css_report(
    calls: DataFrame, end_date: When, windows: MonthWindows | None = None
) -> DataFrame:
    """Retention score per operator with calls in the month of ``end_date``.

    Equal to chaining the operators of ``ringledger.operators.retention``, but reads
    the calls once. They are first counted per operator and caller, with partial
    counts before the shuffle, so however many calls one caller or operator has, a
    later step sees one row per pair. Caller totals, pairs and calls per operator
    are all sums of those rows.
    """
    windows = windows or month_windows(end_date)
    pairs = _pair_counts(calls, windows)
    scores = (
        pairs.where("in_overall > 0")
        .groupBy("UserID")
        .agg(F.sum("in_current").alias("current"), F.sum("in_prior").alias("prior"))
        .select("UserID", score(F.col("current"), F.col("prior")).alias("UserScore"))
    )
    # A pair outside the overall window counts calls but earns no points.
    points = F.when(F.col("in_overall") > 0, F.col("UserScore"))
    # Calls without an operator belong to no agent. The test names the call total too,
    # so that it stays above the aggregation and leaves the shared scan unchanged.
    listed = F.when(F.col("AgentID").isNotNull(), F.col("OutboundCalls")) > 0
    agents = (
        pairs.join(scores, "UserID", "left")
        .groupBy("AgentID")
        .agg(
            *score_sums(points),
            F.sum("all_current").alias("OutboundCalls"),
            F.sum("in_overall").alias("calls_overall"),
        )
        .where(listed & (F.col("calls_overall") > 0))
    )
    return (
        with_ratio(agents)
        .select(
            windows.report_start.alias("StartDate"),
            windows.report_end.alias("EndDate"),
            "AgentID",
            "OutboundCalls",
            "TerpUserScore",
            "PerfectScore",
            "VIScore",
        )
        .orderBy("AgentID")
    )


def _pair_counts(calls: DataFrame, windows: MonthWindows) -> DataFrame:
    moment = F.col("timeWait")
    overall = windows.overall.covers(moment)

    def both(window: Window) -> Column:
        return F.count(F.when(overall & window.covers(moment), 1))

    counted = (
        countable(calls)
        .where(overall | windows.current.covers(moment))
        .groupBy(
            F.col("OperatorID").alias("AgentID"), F.col("UserID_Caller").alias("UserID")
        )
        .agg(
            F.count(F.when(overall, 1)).alias("in_overall"),
            both(windows.current).alias("in_current"),
            both(windows.prior).alias("in_prior"),
            calls_in(windows.current).alias("all_current"),
        )
    )
    # Always true, as each row lies in a window. Both uses of this frame thereby need
    # the same four counts, so Spark sees one plan and reuses its shuffle.
    return counted.where("in_overall + in_current + in_prior + all_current > 0")
