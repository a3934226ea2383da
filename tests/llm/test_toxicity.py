from __future__ import annotations

import zlib
from itertools import combinations

import numpy as np

from ringledger.llm.toxicity import (
    DEPTH,
    LEXICONS,
    Features,
    classify,
    feature_names,
    fit,
    grow,
    isotonic,
    labelled_sample,
)
from tests.conftest import DATA
from tests.llm.test_gam import auc


def one(text: str) -> dict[str, float]:
    return dict(zip(feature_names(), Features().of([b"x y", text.encode(), b""])[1].tolist()))


def test_no_word_is_in_two_lexicons():
    for a, b in combinations(LEXICONS.values(), 2):
        assert not set(a) & set(b)


def test_densities_and_proximity():
    text = "You are such an idiot, IDIOT! And vile vermin they were all of them, said you."
    values, words = one(text), text.split()
    assert np.isclose(values["insults"], 2 / len(words))
    assert np.isclose(values["contempt"], 2 / len(words))
    assert np.isclose(values["any"], 4 / len(words))
    assert values["distinct_hits"] == 3 and values["densest"] == 4
    # The words of address stand first and last; hits are the words 4, 5, 7 and 8.
    gaps = [4, 5, 7, 7]
    assert np.isclose(values["near_second"], 2 / len(words))
    assert np.isclose(values["closeness"], sum(1 / (1 + g) for g in gaps) / 4)
    assert np.isclose(values["upper_word"], 1 / len(words))
    assert np.isclose(values["exclamations"], 1 / len(text))


def test_proximity_stays_within_a_text():
    names = feature_names()
    rows = Features().of([b"you", b"idiot", b"you idiot"])
    assert rows[:, names.index("near_second")].tolist() == [0, 0, 0.5]
    assert rows[:, names.index("closeness")].tolist() == [0, 0, 0.5]
    rows = Features().of([b"a b c", b"d e", b"f g h i"])
    assert rows[:, names.index("spelled_out")].tolist() == [0, 0, 0.25]


def test_masked_words_count_as_what_they_stand_for():
    for word in ("1d1ot", "$tupid", "m*o*r*o*n", "tr@sh", "looooser", "i.d.i.o.t", "scum###", "a$$", "ESTÚPIDO!"):
        assert one(f"the {word} there")["any"] > 0, word
    assert one("the 1d1ot there")["masked"] > 0 and one("an idiot there")["masked"] == 0
    for word in ("1234", "a1", "###", "class", "assess", "e-mail", "x", "as$$$", "pi***"):
        assert one(f"the {word} there")["any"] == 0, word


def test_texts_do_not_depend_on_their_batch():
    texts = [b"", b"you idiot !!", "ünder trottel 1d1ot A B C D".encode(), b"x", b"scum you scum"]
    features = Features()
    together = features.of(texts)
    assert np.array_equal(together, np.concatenate([Features().of([t]) for t in texts]))
    assert np.array_equal(together, features.of(texts))


def test_trees_learn_interactions_and_equal_a_walk_by_hand():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 4)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    model = grow(x[:2000], y[:2000])
    odds = model.log_odds(x[2000:])
    assert auc(odds, y[2000:]) > 0.97
    for row, found in zip(x[2000:2020], odds):
        total = model.intercept
        for features, cuts, leaves in zip(model.features, model.cuts, model.leaves):
            node = 0
            for _ in range(DEPTH):
                feature = features[node]
                right = (model.edges[feature] < row[feature]).sum() >= cuts[node]
                node = 2 * node + 1 + int(right)
            total += leaves[node - len(features)]
        assert abs(total - found) < 1e-9


def test_isotonic_is_the_best_rising_function():
    """Against the min-max formula: the least, over ends, of the largest mean over starts."""
    rng = np.random.default_rng(4)
    odds = rng.integers(0, 12, 60).astype(float)
    y = (rng.random(60) < 1 / (1 + np.exp(6 - odds))).astype(float)
    values = np.unique(odds)
    found = isotonic(odds, y)
    steps = np.searchsorted(found.odds, values)
    for i, value in enumerate(values):
        best = min(
            max(y[(odds >= values[a]) & (odds <= values[b])].mean() for a in range(i + 1))
            for b in range(i, len(values))
        )
        own = next(
            (p for lo, hi, p in _pooled(odds, y) if lo <= value <= hi), None
        )
        assert np.isclose(own, best)
    assert (np.diff(found.chance) >= 0).all() and len(found.odds) == len(_pooled(odds, y))
    assert steps.max() <= len(found.odds)
    scores = found.of(np.linspace(-5, 20, 200))
    assert (np.diff(scores) >= 0).all() and 0 < scores.min() and scores.max() < 1


def _pooled(odds, y):
    """Steps of pool-adjacent-violators, written plainly: lowest, highest value, mean."""
    steps = [(v, v, list(y[odds == v])) for v in np.unique(odds)]
    i = 0
    while i + 1 < len(steps):
        if np.mean(steps[i][2]) >= np.mean(steps[i + 1][2]):
            steps[i : i + 2] = [(steps[i][0], steps[i + 1][1], steps[i][2] + steps[i + 1][2])]
            i = max(i - 1, 0)
        else:
            i += 1
    return [(a, b, np.mean(v)) for a, b, v in steps]


def test_scores_are_calibrated():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(6000, 3)).astype(np.float32)
    chance = 1 / (1 + np.exp(2 - 2 * x[:, 0]))
    y = (rng.random(6000) < chance).astype(float)
    model = fit(x[:4000], y[:4000], np.arange(4000) % 3)
    scores = model.score(x[4000:])
    for low, high in ((0, 0.1), (0.1, 0.3), (0.3, 0.6), (0.6, 1)):
        own = (scores >= low) & (scores < high)
        assert abs(scores[own].mean() - y[4000:][own].mean()) < 0.08


def test_degenerate_fits():
    none = fit(np.zeros((0, 3), np.float32), np.zeros(0), np.zeros(0, int))
    assert (none.score(np.ones((4, 3))) == 0.5).all()
    same = fit(np.zeros((5, 3), np.float32), np.ones(5), np.zeros(5, int))
    assert (same.score(np.ones((4, 3))) > 0.5).all()


def test_the_sample_is_bounded_and_whole_below_the_bound(spark):
    rows = spark.range(3000).selectExpr("id", "array(0f) features")
    assert labelled_sample(rows, rows["id"], 5000).count() == 3000
    some = labelled_sample(rows, rows["id"], 500).collect()
    assert 400 < len(some) <= 500
    assert some == labelled_sample(rows.repartition(7), rows["id"], 500).collect()


def test_held_out_toxic_texts_are_caught_and_clean_ones_left(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.1/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet(f"{DATA}/sf0.1/labels.parquet")
    rows = classify(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in rows)
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    # Abuse is planted in English; labels of other languages have nothing in the text.
    english = [r for r in rows if r["lang"] == "en"]
    scores = np.array([r["score"] for r in english])
    toxic = np.array([r["toxic"] for r in english])
    assert auc(scores, toxic) > 0.98
    assert (scores[toxic == 1] >= 0.3).mean() > 0.9 and (scores[toxic == 0] < 0.3).mean() > 0.99


def test_odd_rows_and_names(spark, odd_docs, no_docs):
    labels = spark.createDataFrame(
        [(1, 1), (1, 0), (None, 1), (2, None), (5, 7), (7, 0)], "doc_id long, toxic int"
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


def test_words_that_no_lexicon_has_are_learned(spark):
    rng = np.random.default_rng(9)
    parts = ["lo", "mer", "tan", "vi", "dus", "kel", "po", "zai"]

    def word():
        return "".join(rng.choice(parts, 3))

    rows, labels = [], []
    for i in range(400):
        words = [word() for _ in range(60)]
        if i % 5 == 0:
            words[7], words[30] = "Grumpf" + word(), "grumpf" + word()
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 5 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    for row in classify(docs, known).where("held_out").collect():
        assert row.predicted == (row.doc_id % 5 == 0), row
