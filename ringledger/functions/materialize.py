"""Write an intermediate once and go on from the written table.

A written table survives the loss of any executor, is scanned with column
pruning, and carries its true size, so the planner's own threshold decides
whether a later join may broadcast it.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and return the written table."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/ringledger/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a single-machine session may fall back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(
            "Set spark.checkpoint.dir to a folder shared by all executors."
        )
    context.setCheckpointDir(tempfile.mkdtemp(prefix="ringledger-"))
    return context.getCheckpointDir().rstrip("/")
