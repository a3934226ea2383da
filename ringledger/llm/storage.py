"""Intermediate tables in the shared folder, removed when the session ends."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path under ``spark.checkpoint.dir``, deleted when Spark's JVM exits.

    The folder must be reachable by all executors. Only a session on one machine may
    leave the setting out, as tests do; it then gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("Set spark.checkpoint.dir to a folder that executors share.")
        folder = tempfile.mkdtemp(prefix="ringledger-llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    path = f"{folder.rstrip('/')}/ringledger-llm/{label}-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(place.getParent())
    files.deleteOnExit(place)
    return path


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return the written table.

    Later steps read the table instead of computing ``df`` again, and a lost executor
    costs no more than the tasks it ran.
    """
    path = shared_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
