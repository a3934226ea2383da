from __future__ import annotations

from types import SimpleNamespace

import pytest

from ringledger.functions.materialize import materialize, shared_folder


class Context:
    """Stands in for a context without a configured folder."""

    def __init__(self, master: str, folder: str | None = None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def session_with(context, configured=None):
    conf = SimpleNamespace(get=lambda name, default: configured or default)
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_the_configured_folder_comes_first():
    session = session_with(Context("yarn", "hdfs://b"), "hdfs://a/")
    assert shared_folder(session) == "hdfs://a"
    assert shared_folder(session_with(Context("yarn", "hdfs://b/"))) == "hdfs://b"


def test_a_cluster_never_uses_a_local_folder():
    with pytest.raises(RuntimeError):
        shared_folder(session_with(Context("yarn")))


def test_a_local_session_keeps_its_temporary_folder():
    session = session_with(Context("local[4]"))
    assert shared_folder(session) == shared_folder(session)


def test_written_tables_keep_rows_and_types(spark):
    df = spark.range(5).selectExpr(
        "id", "cast(id as decimal(17,4)) as amount", "timestamp_ntz'2024-01-01' as t",
        "cast(null as string) as nothing",
    )
    first, second = materialize(df, "check"), materialize(df, "check")
    assert first.dtypes == df.dtypes
    assert first.orderBy("id").collect() == second.orderBy("id").collect() == df.collect()
    assert set(first.inputFiles()).isdisjoint(second.inputFiles())
