from __future__ import annotations

import random
import statistics
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ringledger.functions.skew import HEAVY, fits_broadcast, heavy_keys, spread_join, spread_semi_join
from tests.conftest import physical_plan


@pytest.fixture
def no_broadcast(conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")


def calls(spark, hot: float, number: int = 60_000, places: int = 3_000):
    """Calls of which the share ``hot`` is at one place."""
    place = F.when(F.rand(7) < hot, "hot").otherwise(F.concat(F.lit("C"), F.col("id") % places))
    return spark.range(0, number, 1, 6).select("id", place.alias("place"), F.lit(1).alias("one"))


def codes(spark, places: int = 3_000):
    named = spark.range(places).select(F.concat(F.lit("C"), "id").alias("place"))
    return named.union(spark.sql("select 'hot'"))


@pytest.mark.parametrize("partitions", [8, 200])
@pytest.mark.parametrize("hot", [0.0, 0.34, 0.5, 0.9])
def test_no_task_reads_far_more_than_the_median(spark, conf, no_broadcast, partitions, hot):
    conf("spark.sql.shuffle.partitions", str(partitions))
    joined = spread_semi_join(calls(spark, hot), codes(spark), "place")
    tasks = joined.groupBy(F.spark_partition_id().alias("task")).count().collect()
    read = [r["count"] for r in tasks]
    assert sum(read) == 60_000 and len(read) == partitions
    assert max(read) <= 3 * statistics.median(read)


def test_a_plain_join_would_not_do(spark, conf, no_broadcast):
    conf("spark.sql.shuffle.partitions", "200")
    joined = calls(spark, 0.5).join(codes(spark), "place", "left_semi")
    read = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert max(read) > 50 * statistics.median(read)


@pytest.mark.parametrize("partitions", [8, 200])
def test_heavy_keys_are_few_and_measured(spark, conf, partitions):
    conf("spark.sql.shuffle.partitions", str(partitions))
    assert [r["place"] for r in heavy_keys(calls(spark, 0.5, 20_000), ["place"]).collect()] == ["hot"]
    rows = calls(spark, 0, 20_000, 50 * partitions)
    assert heavy_keys(rows, ["place"]).collect() == []
    few = heavy_keys(calls(spark, 0.2, 20_000, 10), ["place"]).collect()
    assert len(few) == 11 < HEAVY * partitions
    pieces = {r["place"]: r["_pieces"] for r in few}
    assert 1.8 < pieces["hot"] / pieces["C0"] < 3.2


def join_of(rows, keys, how):
    known = Counter(k for k in keys if k[0] is not None)
    if how == "left_semi":
        return Counter(r for r in rows if any(k[0] == r[0] for k in known))
    return Counter((*r, k[1]) for r in rows for k in keys if k[0] is not None and k[0] == r[0])


@pytest.mark.parametrize("how", ["inner", "left_semi"])
@pytest.mark.parametrize("limit", ["10MB", "-1"])
@pytest.mark.parametrize("hot", [0, 0.6])
def test_joins_equal_brute_force(spark, conf, how, limit, hot):
    """Nulls on both sides, copies of keys, keys of one side only, and a hot key."""
    conf("spark.sql.autoBroadcastJoinThreshold", limit)
    rnd = random.Random(5)
    rows = [(1 if rnd.random() < hot else rnd.choice([None, *range(40)]), rnd.randrange(3)) for _ in range(2000)]
    keys = [(rnd.choice([None, *range(1, 60, 2)]), rnd.randrange(2)) for _ in range(60)] + [(1, 7)]
    left = spark.createDataFrame(rows, "k int, v int")
    right = spark.createDataFrame(keys, "k int, w int")
    found = Counter(tuple(r) for r in spread_join(left, right, ["k"], how).collect())
    assert found == join_of(rows, keys, how)
    assert spread_join(left.limit(0), right, ["k"], how).collect() == []
    assert spread_join(left, right.limit(0), ["k"], how).collect() == []


def test_small_keys_are_broadcast_without_counting(spark, tmp_path, conf):
    calls(spark, 0.5).write.parquet(str(tmp_path / "rows"))
    codes(spark).write.parquet(str(tmp_path / "keys"))
    rows, keys = (spark.read.parquet(str(tmp_path / n)) for n in ("rows", "keys"))
    assert fits_broadcast(keys)
    plan = physical_plan(spread_semi_join(rows, keys, "place"))
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    conf("spark.sql.autoBroadcastJoinThreshold", "100")
    assert not fits_broadcast(keys)
    assert "_salt" in physical_plan(spread_semi_join(rows, keys, "place"))
