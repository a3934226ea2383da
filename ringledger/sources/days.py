"""Tables laid out by day: read for a window of time, and replaced day by day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType

from ringledger.operators.windows import Window

#: The folder column of the layout.
DAY = "day"


def replace_days(df: DataFrame, path: str, moment: str, window: Window, column: str = DAY) -> None:
    """Write ``df`` by day of ``moment``, in place of what the table had for the window's days.

    Rows outside the days that ``window`` touches, or without a time, are refused. Days of
    the window without rows come out empty, all other days stay as they are; so a run that
    is repeated leaves the same table. A new table is made where there is none.

    Each day's files are put in place when all have been written; days that have no rows
    any more are removed after that.
    """
    spark = df.sparkSession
    first, last = _days_of(spark, window)
    day = F.col(moment).cast("date")
    inside = F.coalesce(day.between(F.lit(first), F.lit(last)), F.lit(False))
    wrong = F.raise_error(F.concat(F.lit(f"{moment} lies outside the days replaced: "),
                                   F.coalesce(F.col(moment).cast("string"), F.lit("null"))))
    rows = df.withColumn(column, F.when(inside, day).otherwise(wrong.cast("date")))
    stale = [(name, place) for name, place in _folders(spark, path, column) if first <= name <= last]
    # As many rows as the window has days, and none where no day could go stale.
    present = {r[0] for r in rows.select(column).distinct().collect()} if stale else set()
    # A day goes to a few tasks whatever its size, and adaptive execution splits large ones.
    dealt = rows.hint("rebalance", column)
    dealt.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(column).parquet(path)
    for name, place in stale:
        if name not in present:
            place.getFileSystem(_hadoop(spark)).delete(place, True)


def read_days(
    spark: SparkSession, path: str, schema: StructType, window: Window, column: str = DAY
) -> DataFrame:
    """The days that ``window`` touches, in the columns of ``schema`` and without ``column``.

    The days are a filter on the folder column with constant bounds, so only their files
    are listed as input. Times inside the days are for the caller to test. A closed
    window touches the day it ends on; an open one touches it unless it ends at midnight.
    """
    first, last = window.start.cast("date"), _last_day(window)
    table = spark.read.schema(StructType([*schema.fields]).add(column, DateType())).parquet(path)
    return table.where(F.col(column).between(first, last)).drop(column)


def _last_day(window: Window) -> Column:
    stop = window.stop.cast("timestamp_ntz")
    return (stop if window.closed else stop - F.expr("interval 1 microsecond")).cast("date")


def _days_of(spark: SparkSession, window: Window) -> tuple[date, date]:
    row = spark.range(1).select(window.start.cast("date"), _last_day(window)).first()
    return row[0], row[1]


def _hadoop(spark: SparkSession):
    return spark._jsc.hadoopConfiguration()


def _folders(spark: SparkSession, path: str, column: str) -> list[tuple[date, object]]:
    """The day folders of a table."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(_hadoop(spark))
    out = []
    for status in files.listStatus(place) if files.exists(place) else []:
        name = status.getPath().getName()
        if name.startswith(f"{column}=") and not name.endswith("__HIVE_DEFAULT_PARTITION__"):
            out.append((date.fromisoformat(name.split("=")[1]), status.getPath()))
    return out
