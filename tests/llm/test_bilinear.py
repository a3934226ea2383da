from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from ringledger.llm import bilinear
from ringledger.llm.bilinear import CLASSES, LogBilinear, score
from tests.conftest import DATA

END = b"\n"


def tokens(text):
    return (text or "").encode().lower().split() + [END]


def learned(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 7 != 2


@pytest.mark.parametrize("hot", [2_000_000, 50])
def test_base_scores_by_brute_force(spark, odd_docs, monkeypatch, hot):
    """Also with most words outside the broadcast part."""
    monkeypatch.setattr(bilinear, "HOT", hot)
    monkeypatch.setattr(bilinear, "STEPS", 5)
    more = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").select("doc_id", "text")
    for docs in (odd_docs.select("doc_id", "text"), more):
        given = [(r["doc_id"], r["text"]) for r in docs.collect()]
        counts = Counter(t for i, text in given if learned(i) for t in tokens(text))
        n, v = sum(counts.values()), len(counts)
        expected = Counter()
        for i, text in given:
            own = tokens(text)
            base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in own)
            expected[i, not learned(i), len(own), sum(counts[t] > 0 for t in own), n, round(base, 6)] += 1
        names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens"]
        found = Counter(
            (*(r[c] for c in names), round(r["base_score"], 6)) for r in score(docs).collect()
        )
        assert found == expected


def test_class_probabilities_are_normalised_and_learned():
    rng = np.random.default_rng(0)
    counts = np.zeros(CLASSES**3, np.int64)
    for last in range(CLASSES):  # after each class, one of two follows
        for before in rng.integers(0, CLASSES, 20):
            for follows in (last * 7 % CLASSES, last * 11 % CLASSES):
                counts[(before * CLASSES + last) * CLASSES + follows] += 5
    model = LogBilinear()
    model.train(counts)
    table = model.log10_probabilities().astype(float)
    sums = (10 ** table.reshape(-1, CLASSES)).sum(axis=1)
    assert np.allclose(sums, 1, atol=1e-4)
    some = np.flatnonzero(counts)
    uniform = -np.log10(CLASSES)
    assert (table[some] * counts[some]).sum() / counts.sum() > uniform + 0.8


def test_scores_are_a_distribution_over_known_and_unknown_words(spark):
    """The chances of all words and of an unknown one of each class add up to 1."""
    text = " ".join(f"w{i} " * (i % 5 + 1) for i in range(200))
    docs = spark.createDataFrame([(0, text)], "doc_id long, text string")
    known = bilinear.lexicon(bilinear.count_words(docs), 1)
    counts = Counter(tokens(text)[:-1])
    classes = bilinear._Classes(known)
    ids, _ = classes.number([b" ".join(counts)])
    total = np.zeros(CLASSES)
    for word, number in zip(counts, ids):
        kind = classes.classes[number]
        if kind > bilinear.FREQUENT:
            total[kind] += (counts[word] + 1) / known.class_sizes[kind]
    for kind in set(classes.classes) - set(range(bilinear.FREQUENT + 1)):
        assert total[kind] + 1 / known.class_sizes[kind] == pytest.approx(1)


def test_held_out_scores_beat_the_base(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet").select("doc_id", "text")
    rows = score(docs).where("held_out").collect()
    assert len(rows) > 100
    assert sum(r["score"] for r in rows) > 0.985 * sum(r["base_score"] for r in rows)
    assert sum(r["score"] > r["base_score"] for r in rows) > 0.9 * len(rows)


def test_odd_rows_and_names(odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr(bilinear, "STEPS", 5)
    new = ["held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    found = score(odd_docs)
    assert found.columns == [c for c in odd_docs.columns if c not in ("text", *new)] + new
    assert found.count() == odd_docs.count()
    assert score(no_docs).collect() == []
