"""Steps of the monthly caller-retention report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringledger.operators.windows import MonthWindows, Window

# Fixed values of the score: a caller lost or new scores 0, one who kept calling at
# 95 % or more of the month before scores 3, any other 2.
NONE, KEPT, DECLINED = 0, 3, 2


def countable(calls: DataFrame) -> DataFrame:
    """Reported outbound calls placed by real callers (ids above 1)."""
    return calls.where(
        (F.col("Outbound") == 1) & (F.col("isReport") == 1) & (F.col("UserID_Caller") > 1)
    )


def calls_in(window: Window) -> Column:
    return F.count(F.when(window.covers(F.col("timeWait")), 1))


def score(current: Column, prior: Column) -> Column:
    """Growth of at least -5 %, tested in whole numbers so that it is exact."""
    return (
        F.when(prior == 0, NONE)
        .when((current - prior) * 20 >= -prior, KEPT)
        .otherwise(DECLINED)
    )


def user_score(calls: DataFrame, windows: MonthWindows) -> DataFrame:
    """Calls in both months and the score, per caller."""
    current, prior = F.col("PriorMonth1"), F.col("PriorMonth2")
    return (
        countable(calls)
        .where(windows.overall.covers(F.col("timeWait")))
        .groupBy(F.col("UserID_Caller").alias("UserID"))
        .agg(
            calls_in(windows.current).alias("PriorMonth1"),
            calls_in(windows.prior).alias("PriorMonth2"),
        )
        .withColumn("UserScore", score(current, prior))
    )


def terp_score(calls: DataFrame, scores: DataFrame, windows: MonthWindows) -> DataFrame:
    """Each pair of operator and caller once, with the caller's score."""
    pairs = (
        countable(calls)
        .where(windows.overall.covers(F.col("timeWait")))
        .select(F.col("OperatorID").alias("AgentID"), F.col("UserID_Caller").alias("UserID"))
        .distinct()
    )
    scored = scores.select("UserID", F.col("UserScore").alias("TerpScore"))
    return pairs.join(scored, "UserID", "left").select("AgentID", "UserID", "TerpScore")


def outbound_calls(calls: DataFrame, current: Window) -> DataFrame:
    """Calls of the current month, per operator."""
    return (
        countable(calls)
        .where(current.covers(F.col("timeWait")))
        .groupBy(F.col("OperatorID").alias("AgentID"))
        .agg(F.count(F.lit(1)).alias("OutboundCalls"))
    )


def agent_score(pairs: DataFrame, outbound: DataFrame) -> DataFrame:
    """Score sum, best possible score and their ratio, per agent with current calls.

    Pairs are summed before the join, so one row per agent is shuffled.
    """
    sums = pairs.groupBy("AgentID").agg(*score_sums(F.col("TerpScore")))
    return with_ratio(sums.join(outbound, "AgentID"))


def score_sums(points: Column) -> list[Column]:
    rated = F.count(F.when(points.isin(DECLINED, KEPT), 1))
    return [
        F.sum(points).alias("TerpUserScore"),
        (rated * KEPT).alias("PerfectScore"),
    ]


def with_ratio(sums: DataFrame) -> DataFrame:
    best = F.coalesce(F.nullif(F.col("PerfectScore"), F.lit(0)), F.lit(1))
    # decimal(20,4) operands leave more than ten places in the quotient.
    ratio = F.col("TerpUserScore").cast("decimal(20,4)") / best.cast("decimal(20,4)")
    return sums.select(
        "AgentID",
        "OutboundCalls",
        "TerpUserScore",
        "PerfectScore",
        ratio.cast("decimal(15,10)").cast("double").alias("VIScore"),
    )
