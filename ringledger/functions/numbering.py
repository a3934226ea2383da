"""Consecutive row numbers in a total order, without a single-partition window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ringledger.functions.materialize import materialize

_SLOT = "_slot"
_PART = "_part"
_BEFORE = "_before"


def number_rows(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Add an int column numbering the rows 1..n by ``order``.

    ``row_number()`` over an unpartitioned window would sort every row in one task.
    Here a range sort spreads the rows, each partition numbers its own, and the
    rows of earlier partitions are added as an offset. The sorted rows are written
    first, because the offsets only fit the partitions they were counted in. The
    one unpartitioned window left runs over a row per partition.

    ``order`` must identify a row, or numbers within a tie are arbitrary.
    """
    ordered = df.orderBy(*order).withColumn(_SLOT, F.monotonically_increasing_id())
    written = materialize(ordered, "numbered")

    # monotonically_increasing_id keeps the partition above bit 33, the row below.
    part = F.shiftright(F.col(_SLOT), 33)
    position = F.col(_SLOT).bitwiseAND(F.lit((1 << 33) - 1))

    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        written.groupBy(part.alias(_PART))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(_PART, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias(_BEFORE))
    )
    return (
        written.withColumn(_PART, part)
        .join(offsets, _PART)
        .withColumn(name, (F.col(_BEFORE) + position + 1).cast("int"))
        .drop(_PART, _BEFORE, _SLOT)
    )
