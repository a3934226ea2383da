from __future__ import annotations

from collections import defaultdict

import pytest

from ringledger.llm.sharding import find_splitters, shard_by_bytes
from tests.conftest import physical_plan


def check(rows, shards, largest):
    by_shard = defaultdict(list)
    for row in rows:
        by_shard[row["shard"]].append(row)
    total = sum(row["size"] for row in rows)
    for own in by_shard.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    for i in range(shards):
        size = sum(r["size"] for r in by_shard[i])
        assert abs(size - total / shards) <= largest + 0.001 * total / shards


def test_near_equal_bytes_and_gapless_slots(spark):
    rows = [(i, "x" * (i * 7919 % 500)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = shard_by_bytes(docs).collect()
    assert {(r["doc_id"], r["text"]) for r in found} == set(rows)
    assert all(r["size"] == len(r["text"]) + 1 for r in found)
    check(found, 8, 501)


@pytest.mark.parametrize("same_id", [False, True])
def test_a_group_of_copies_is_cut(spark, same_id):
    rows = [(0 if same_id else i, "copy " * 20) for i in range(1500)]
    rows += [(i, f"text {i}") for i in range(5000, 5500)]
    found = shard_by_bytes(spark.createDataFrame(rows, "doc_id long, text string"))
    check(found.collect(), 8, 101)


def test_equal_texts_are_neighbours(spark):
    rows = [(i, f"text {i % 50} " * 3) for i in range(1000)]
    found = shard_by_bytes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    order = [r["text"] for r in sorted(found, key=lambda r: (r["shard"], r["slot"]))]
    assert sum(a != b for a, b in zip(order, order[1:])) == 49


def test_splitters_by_brute_force(spark):
    keys = [(k * 2**50, 0, 0, 1 + k % 9) for k in range(4096)]
    df = spark.createDataFrame(keys, "k0 long, k1 long, k2 long, size long")
    total = sum(k[3] for k in keys)
    for i, splitter in enumerate(find_splitters(df, 4, 0.0), 1):
        below = sum(k[3] for k in keys if k[:3] < splitter)
        assert abs(below - total * i / 4) <= 9 / 2


def test_odd_rows_and_names(odd_docs, no_docs):
    found = shard_by_bytes(odd_docs)
    assert found.columns == [c for c in odd_docs.columns if c not in ("size", "shard", "slot")] + ["size", "shard", "slot"]
    rows = found.collect()
    assert len(rows) == odd_docs.count()
    assert sorted(r["size"] for r in rows if r["text"] is None) == [1]
    assert shard_by_bytes(no_docs).collect() == []


def test_no_python(odd_docs):
    plan = physical_plan(shard_by_bytes(odd_docs))
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
