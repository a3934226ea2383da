"""Tables stored by the hash of a key, so that joins on it need no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_bucketed(df: DataFrame, table: str, path: str, by: str, buckets: int) -> None:
    """Store ``df`` at ``path`` as the catalog's ``table``, in ``buckets`` by hash of ``by``.

    Rows are dealt to the buckets before they are written, so each bucket is one file of
    each task that holds it, sorted by the key. Tables that are joined need the same number
    of buckets.
    """
    dealt = df.repartition(buckets, by)
    writer = dealt.write.bucketBy(buckets, by).sortBy(by).mode("overwrite")
    writer.option("path", path).format("parquet").saveAsTable(table)


def read_bucketed(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)
