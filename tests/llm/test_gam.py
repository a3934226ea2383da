from __future__ import annotations

import zlib

import numpy as np

from ringledger.llm.gam import FEATURES, Features, classify, fit
from tests.conftest import DATA


def auc(scores, labels):
    good, bad = scores[labels == 1], scores[labels == 0]
    return (good[:, None] > bad[None]).mean() + 0.5 * (good[:, None] == bad[None]).mean()


def test_tables_and_pairs_are_learned():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(6000, 4)).astype(np.float32)
    odds = 3 * (np.abs(x[:, 0]) < 1) + 5 * (x[:, 1] * x[:, 2] > 0) - 4
    y = (rng.random(6000) < 1 / (1 + np.exp(-odds))).astype(float)
    model = fit(x[:4000], y[:4000])
    assert auc(model.probability(x[4000:]), y[4000:]) > 0.88
    assert any({i, j} == {1, 2} for i, j, _ in model.pairs)


def test_the_score_is_a_sum_of_table_entries():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 3)).astype(np.float32)
    model = fit(x, (x[:, 0] > 0).astype(float))
    for row in x[:20]:
        total = model.intercept
        for value, edges, table in zip(row, model.edges, model.tables):
            total += table[(edges < value).sum()]
        for i, j, table in model.pairs:
            total += table[(model.coarse[i] < row[i]).sum(), (model.coarse[j] < row[j]).sum()]
        assert abs(model.log_odds(row[None])[0] - total) < 1e-9


def test_without_rows_every_score_is_one_half():
    model = fit(np.zeros((0, len(FEATURES)), np.float32), np.zeros(0))
    assert (model.probability(np.ones((3, len(FEATURES)))) == 0.5).all()


def test_features():
    texts = [b"", "A b!\nA b!\né 12 #".encode()]
    empty, row = Features().of(texts)
    assert not empty.any()
    value = dict(zip(FEATURES, row.tolist()))
    assert value["log_words"] == np.float32(np.log1p(7))
    assert abs(value["distinct_share"] - 5 / 7) < 1e-6
    assert abs(value["repeated_line_share"] - 1 / 3) < 1e-6
    size = len(texts[1])
    for name, count in {"digits": 2, "upper": 2, "exclamations": 2, "wide": 1, "symbols": 1}.items():
        assert abs(value[name] - count / size) < 1e-6


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{DATA}/sf0.01/labels.parquet")
    rows = classify(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 for r in rows)
    assert auc(np.array([r["score"] for r in rows]), np.array([r["quality"] for r in rows])) > 0.95
    assert all(r["predicted"] == int(r["score"] >= 0.5) for r in rows)


def test_odd_rows_and_names(spark, odd_docs, no_docs):
    labels = spark.createDataFrame(
        [(1, 1), (1, 0), (None, 1), (2, None), (5, 7), (7, 0)], "doc_id long, quality int"
    )
    found = classify(odd_docs, labels)
    assert found.columns == [
        c for c in odd_docs.columns if c not in ("text", "held_out", "score")
    ] + ["held_out", "score", "predicted"]
    rows = found.collect()
    assert len(rows) == odd_docs.count()
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert classify(no_docs, labels).collect() == []
    assert {r["score"] for r in classify(odd_docs, labels.limit(0)).collect()} == {0.5}
