"""Joins that stay even when one key holds much of the data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is heavy from this part of a task's fair share of the rows.
HEAVY = 4
#: Pieces that a fair share is cut into, so that chance deals them out evenly.
PIECES = 16
_SALT, _PIECES = "_salt", "_pieces"


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark's own estimate of ``df`` is below the broadcast threshold.

    The estimate comes with the plan, so no job runs. It counts whole files and multiplies
    the sides of a join, so it errs on the large side.
    """
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return size <= limit


def heavy_keys(rows: DataFrame, on: list[str]) -> DataFrame:
    """``on`` and ``_pieces`` of the keys that one task should not get whole.

    Rows are counted by key, with partial counts before the shuffle. A task's fair share is
    all rows over the number of shuffle partitions; a key with over a quarter of that is
    heavy and gets ``PIECES`` pieces for each fair share. So there are fewer than
    ``HEAVY`` heavy keys for each partition, however many keys there are.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows"))
    fair = counts.agg(F.sum("_rows") / F.lit(tasks)).scalar()
    pieces = F.ceil(F.col("_rows") * PIECES / fair).cast("int").alias(_PIECES)
    return counts.where(F.col("_rows") * HEAVY > fair).select(*on, pieces)


def spread_join(rows: DataFrame, keys: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """``rows`` joined to ``keys`` (``inner`` or ``left_semi``) by the columns ``on``.

    Where the keys are small enough to be broadcast, that is a plain join. Otherwise the
    rows of a heavy key are dealt to as many pieces as it was measured to need, and its keys
    come with each of them; all other keys are joined as they are. The pieces are part of
    the join key, so an aggregation that follows shuffles its rows anew.
    """
    if how == "left_semi":
        keys = keys.select(*on)
    if fits_broadcast(keys):
        return rows.join(keys, on, how)
    # Fewer rows than HEAVY times the shuffle partitions: see heavy_keys.
    heavy = F.broadcast(heavy_keys(rows, on))
    pieces = F.coalesce(F.col(_PIECES), F.lit(1))
    salted = rows.join(heavy, on, "left").withColumn(
        _SALT, F.pmod(F.monotonically_increasing_id(), pieces).cast("int")
    )
    if how == "left_semi":
        keys = keys.distinct()
    every = F.explode(F.sequence(F.lit(0), pieces - 1))
    repeated = keys.join(heavy, on, "left").withColumn(_SALT, every).drop(_PIECES)
    return salted.drop(_PIECES).join(repeated, [*on, _SALT], how).drop(_SALT)


def spread_semi_join(rows: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose ``on`` occurs in ``keys``, in their columns' order."""
    return spread_join(rows, keys, [on], "left_semi").select(*rows.columns)
