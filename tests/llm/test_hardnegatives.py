from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ringledger.llm.hardnegatives import (
    Anchors,
    directions,
    hard_negatives,
    matrix,
    products,
    walk,
)

KINDS = "vec_id long, embedding array<float>, label int"


def brute_force(rows, anchor, positives=5, negatives=3, low=50, high=95, scale=256):
    """From triples of id, components and label."""
    some = []
    for i, vector, label in rows:
        if i is None or vector is None or label is None:
            continue
        if all(x is not None and math.isfinite(x) for x in vector):
            some.append((i, [math.floor(scale * x) for x in vector], label))
    chosen = {}
    for i, vector, label in some:
        if anchor(i):
            chosen[i] = min(chosen.get(i, (label, vector)), (label, vector))
    out = []
    for a, (label, vector) in chosen.items():
        best = {True: {}, False: {}}
        for i, other, its in some:
            score = sum(x * y for x, y in zip(vector, other))
            if i != a:
                known = best[its == label]
                known[i] = max(known.get(i, score), score)
        ranked = {k: sorted((-s, i) for i, s in v.items()) for k, v in best.items()}
        for s, p in ranked[True][:positives]:
            inside = [(n, i) for n, i in ranked[False] if low * -s <= 100 * -n <= high * -s]
            for rank, (n, i) in enumerate(inside[:negatives], 1):
                out.append((a, p, rank, i, -s, -n))
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.collect())


def around(rng, number, labels=4, wide=6, spread=0.5):
    """Unit vectors near a direction for each label, as float32 holds them."""
    centres = rng.normal(size=(labels, wide))
    label = rng.integers(0, labels, number)
    x = centres[label] + spread * rng.normal(size=(number, wide))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    return [(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, label))]


@pytest.mark.parametrize("batch_bytes, block_rows", [(1 << 20, 1 << 15), (600, 70)])
@pytest.mark.parametrize("scale", [256, 3])
def test_by_brute_force(spark, batch_bytes, block_rows, scale):
    """Also with several batches and blocks, and with many equal scores."""
    rows = around(np.random.default_rng(1), 500)
    df = spark.createDataFrame(rows, KINDS).repartition(3)
    got = hard_negatives(
        df, F.col("id") % 20 == 0, scale=scale, batch_bytes=batch_bytes, block_rows=block_rows
    )
    expected = brute_force(rows, lambda i: i % 20 == 0, scale=scale)
    assert len(expected) > 100 and found(got) == expected


def test_equal_vectors_are_taken_by_id(spark):
    rows = [(i, [1.0, 0.0], 0) for i in range(300)] + [(i, [0.7, 0.7], 1) for i in range(300, 600)]
    got = found(hard_negatives(spark.createDataFrame(rows, KINDS).repartition(5), F.col("id") == 50))
    assert got == brute_force(rows, lambda i: i == 50)
    assert [r[1] for r in got[::3]] == [0, 1, 2, 3, 4] and {r[3] for r in got} == {300, 301, 302}


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = around(np.random.default_rng(2), 80, labels=2)
    rows += [
        (None, rows[0][1], 0), (100, None, 0), (120, rows[0][1], None), (140, [nan] * 6, 1),
        (160, [inf] + [0.0] * 5, 0), (161, [-inf] * 6, 1), (180, [None] * 6, 0), (200, [], 0),
        (201, [], 1), (220, [0.5], 1), (221, [0.5] * 9, 0), (240, [0.0] * 6, 0),
        (0, rows[5][1], 1), (0, rows[9][1], 0), (7, rows[8][1], 1), (-20, rows[4][1], 0),
    ]
    rows += [rows[3], rows[3], rows[40], rows[20]]
    df = spark.createDataFrame(rows, KINDS)
    extra = df.selectExpr("*", "'x' as id", "1 as vector", "2 as goal", "3 as score", "4 as rank")
    expected = brute_force(rows, lambda i: i % 20 == 0)
    assert found(hard_negatives(extra, F.col("id") % 20 == 0)) == expected
    assert {0, 20, 40, 60, -20} <= {r[0] for r in expected}
    assert hard_negatives(df.limit(0), F.col("id") % 20 == 0).collect() == []
    assert hard_negatives(df, F.col("id") == 10**9).collect() == []
    none = spark.createDataFrame([(0, [1.0], 0), (1, [1.0], 1)], KINDS)
    assert hard_negatives(none, F.col("id") == 0).collect() == []


def test_windows_of_zero_and_negative_positives(spark):
    rows = [(0, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [-1.0, 0.0], 0), (3, [0.0, 2.0], 1), (4, [-0.7, 0.0], 1)]
    got = found(hard_negatives(spark.createDataFrame(rows, KINDS), F.col("id") == 0))
    assert got == brute_force(rows, lambda i: i == 0) == [(0, 1, 1, 3, 0, 0)]


def test_scores_are_exact_for_large_components(spark):
    rng = np.random.default_rng(3)
    for most in (100, 10**5, 10**8, 3 * 10**8):
        u = rng.integers(-most, most, (5, 7))
        x = rng.integers(-most, most, (9, 7))
        exact = [[sum(int(a) * int(b) for a, b in zip(p, q)) for q in x] for p in u]
        assert products(u.astype(float), x.astype(float)).tolist() == exact
    rows = [(i, [2.0**22 + i, 3.0 * i], i % 2) for i in range(50)]
    got = found(hard_negatives(spark.createDataFrame(rows, KINDS), F.col("id") % 10 == 0, low=0, high=100))
    assert got == brute_force(rows, lambda i: i % 10 == 0, low=0, high=100)


def test_the_walk_ends_early_where_rows_gather_around_directions():
    rng = np.random.default_rng(4)
    rows = around(rng, 20_000, labels=20, wide=32, spread=0.02)
    x = np.floor(256 * np.array([r[1] for r in rows]))
    labels = np.array([r[2] for r in rows])
    chosen = np.arange(0, 20_000, 100)
    centres = directions(x[chosen], 32)
    ends = np.iinfo(np.int64)
    anchors = Anchors(
        chosen, labels[chosen], x[chosen], centres, np.arange(200), np.full(200, ends.min),
        np.full(200, ends.max), True, 5,
    )
    scored: list[int] = []
    best = walk(anchors, np.arange(20_000), labels, x, scored)
    assert sum(scored) < 0.6 * sum((labels == labels[a]).sum() for a in chosen)
    for goal, a in enumerate(chosen[:30]):
        scores = (x @ x[a]).astype(np.int64)
        other = np.flatnonzero((labels == labels[a]) & (np.arange(20_000) != a))
        first = other[np.lexsort((other, -scores[other]))][:5]
        assert best.id[best.goal == goal].tolist() == first.tolist()
    # Windows above all scores end before anything is scored.
    high = Anchors(
        chosen, labels[chosen], x[chosen], centres, np.arange(200), np.full(200, 10**6),
        np.full(200, 10**7), False, 3,
    )
    scored.clear()
    assert not len(walk(high, np.arange(20_000), labels, x, scored).goal) and not scored


def test_directions_do_not_change_results():
    rng = np.random.default_rng(5)
    x = np.floor(256 * rng.normal(size=(600, 5)))
    labels, ids = rng.integers(0, 3, 600), rng.permutation(600)
    ends = np.iinfo(np.int64)
    results = []
    for centres in (directions(x[:40], 1), directions(x[:40], 16), np.zeros((1, 5)), -directions(x[:40], 4)):
        anchors = Anchors(
            ids[:40], labels[:40], x[:40], centres, np.arange(40), np.full(40, ends.min),
            np.full(40, ends.max), False, 4,
        )
        best = walk(anchors, ids, labels, x)
        results.append((best.goal.tolist(), best.id.tolist(), best.score.tolist()))
    assert all(r == results[0] for r in results)


def test_lists_of_any_length():
    lists = pa.array([[1.0, 2.0], [], [3.0]], pa.list_(pa.float64()))
    assert matrix(lists).tolist() == [[1, 2], [0, 0], [3, 0]]
    assert matrix(lists.slice(2)).tolist() == [[3]]
    assert matrix(lists.slice(0, 0)).shape == (0, 0)
