from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ringledger.llm import perplexity
from ringledger.llm.perplexity import ORDER, Model, count_ngrams, quality_rules
from tests.conftest import DATA

WORDS = "the then there cat cats at hat mat the the cat sat on a mat é él".split()


def counts_by_brute_force(words):
    found = Counter()
    for word in words:
        spelled = f"\x02{word}\x03"
        for i in range(1, len(spelled)):
            found[spelled[max(0, i - ORDER + 1) : i + 1]] += 1
    return found


def model_by_brute_force(words):
    """Interpolated modified Kneser-Ney, from its definition."""
    raw = counts_by_brute_force(words)
    levels = {ORDER: {g: n for g, n in raw.items() if len(g) == ORDER}}
    for m in range(ORDER - 1, 0, -1):
        lower = Counter(g[1:] for g in levels[m + 1])
        if m > 1:
            lower.update({g: n for g, n in raw.items() if len(g) == m and g[0] == "\x02"})
        levels[m] = dict(lower)
    discounts = {}
    for m, level in levels.items():
        t = Counter(level.values())
        y = t[1] / max(1, t[1] + 2 * t[2])
        discounts[m] = [
            max(0.1, min(i, i - (i + 1) * y * t[i + 1] / max(1, t[i]))) for i in (1, 2, 3)
        ]

    def probability(gram):
        m = len(gram)
        if not m:
            return 1 / 0x110000
        lower = probability(gram[1:])
        level = levels[m]
        after = {g: n for g, n in level.items() if g[:-1] == gram[:-1]}
        if not after:
            return lower
        total, d = sum(after.values()), discounts[m]
        left = sum(d[min(n, 3) - 1] for n in after.values()) / total
        n = after.get(gram, 0)
        return (max(0.0, n - d[min(n, 3) - 1]) / total if n else 0.0) + left * lower

    def log(word):
        spelled = f"\x02{word}\x03"
        return sum(
            math.log(probability(spelled[max(0, i - ORDER + 1) : i + 1]))
            for i in range(1, len(spelled))
        )

    return log


@pytest.fixture(scope="module")
def docs(spark):
    texts = [(i, " ".join(WORDS[i::3])) for i in range(3)]
    return spark.createDataFrame(texts, "doc_id long, text string")


def test_counts(docs):
    found = {r["gram"]: r["count"] for r in count_ngrams(docs).collect()}
    assert found == counts_by_brute_force(WORDS)


def test_probabilities_by_brute_force(docs):
    log, model = model_by_brute_force(WORDS), Model.fit(docs)
    words = ["the", "cat", "thecat", "zebra", "él", "a"]
    found = model.log_probabilities([w.encode() for w in words])
    for word, value in zip(words, found):
        assert value == pytest.approx(log(word), rel=1e-4)


def test_blocks_of_words_count_the_same(docs, monkeypatch):
    whole = {r["gram"]: r["count"] for r in count_ngrams(docs).collect()}
    words = [w.encode() for w in dict.fromkeys(WORDS)]
    times = [WORDS.count(w.decode()) for w in words]
    monkeypatch.setattr(perplexity, "_BLOCK_WORDS", 3)
    import numpy as np

    batch = perplexity._grams(words, np.array(times))
    assert dict(zip(batch.column("gram").to_pylist(), batch.column("n").to_pylist())) == whole


def test_every_ngram_has_its_own_entry(spark):
    """40,000 random words: n-grams that share an entry would be fewer than counted."""
    random = np.random.default_rng(1)
    letters = random.integers(ord("a"), ord("z") + 1, (40_000, 5))
    words = ["".join(map(chr, row)) for row in letters.tolist()]
    docs = spark.createDataFrame([(0, " ".join(words))], "doc_id long, text string")
    longest = {g for g in counts_by_brute_force(words) if len(g) == ORDER}
    keys, values = Model.fit(docs).parts[ORDER]
    assert len(keys) == len(values) == len(set(keys.tolist())) == len(longest)


def base_by_brute_force(text):
    words = (text or "").encode().split()
    windows = defaultdict(list)
    for i in range(len(words) - 2):
        windows[tuple(words[i : i + 3])].append(i)
    repeated = {p + s for own in windows.values() if len(own) > 1 for p in own for s in range(3)}
    lines, seen, again = (text or "").split("\n"), set(), 0
    for line in lines:
        if line.strip(" \t\n\x0b\f\r"):
            again += line in seen
            seen.add(line)
    chars = sum(len(w.decode()) for w in words)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return len(words), chars, symbols, again, len(repeated), failed


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_base_rules_by_brute_force(spark, odd_docs):
    more = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    for docs in (odd_docs, more):
        for row in quality_rules(docs).collect():
            assert tuple(row[c] for c in BASE) == base_by_brute_force(row["text"])


def test_bands(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/sf0.01/labels.parquet")
    rows = quality_rules(docs).where("not base_failed").join(labels, "doc_id").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    junk = [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(good) >= 0.98 * len(good)
    assert sum(junk) <= 0.6 * len(junk)
    for r in rows:
        assert r["kept"] == (r["lower"] <= r["log_perplexity"] <= r["upper"])


def test_a_third_of_a_language_as_junk(spark):
    """The junk is alike in itself, so quartiles would take it for the language's own."""
    random = np.random.default_rng(2)
    usual = ["".join(map(chr, random.integers(97, 105, 5).tolist())) for _ in range(300)]

    def text(junk):
        if junk:
            return " ".join("".join(map(chr, w)) for w in random.integers(97, 123, (60, 6)).tolist())
        return " ".join(random.choice(usual, 60))

    docs = spark.createDataFrame(
        [(i, text(i % 3 == 0), "en") for i in range(600)], "doc_id long, text string, lang string"
    )
    rows = quality_rules(docs).collect()
    assert not any(r["kept"] for r in rows if r["doc_id"] % 3 == 0)
    assert all(r["kept"] for r in rows if r["doc_id"] % 3)


def test_odd_rows_and_names(odd_docs, no_docs):
    found = quality_rules(odd_docs)
    new = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
           "log_perplexity", "lower", "upper", "base_failed", "kept"]
    assert found.columns == [c for c in odd_docs.columns if c != "kept"] + new
    rows = found.collect()
    assert len(rows) == odd_docs.count()
    assert all(not r["kept"] and r["log_perplexity"] is None for r in rows if not r["n_words"])
    assert quality_rules(no_docs).collect() == []


@pytest.mark.parametrize("share", [0.33, 0.45, 0.56])
def test_copies_of_one_text_do_not_move_the_band(spark, share):
    """Up to most of a language may be copies of one good text."""
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet").where("lang = 'en'")
    docs = docs.select("doc_id", "lang", "text")
    labels = spark.read.parquet(f"{DATA}/sf0.01/labels.parquet")
    n = docs.count()
    text = docs.join(labels.where("quality = 1"), "doc_id").where("length(text) > 600")
    text = text.orderBy("doc_id").first()["text"]
    copies = spark.range(int(n * share / (1 - share))).select(
        (-1 - F.col("id")).alias("doc_id"), F.lit("en").alias("lang"), F.lit(text).alias("text")
    )

    def kept(rows):
        rows = quality_rules(rows).where("not base_failed").join(labels, "doc_id", "left")
        return [(r["doc_id"], r["quality"], r["kept"]) for r in rows.collect()]

    without, found = kept(docs), kept(docs.unionByName(copies))
    assert sorted(r for r in found if r[0] >= 0) == sorted(without)
    assert all(r[2] for r in found if r[0] < 0)
    good = [r[2] for r in without if r[1] == 1]
    assert sum(good) >= 0.98 * len(good)


def test_few_words_at_once(spark, monkeypatch):
    """A vocabulary that fills up changes neither counts nor scores."""
    docs = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").select("text")
    texts = [(r["text"] or "").encode() for r in docs.collect()]
    model = Model.fit(docs)

    def run():
        grams = {r["gram"]: r["count"] for r in count_ngrams(docs).collect()}
        scorer = perplexity._Scorer(model)
        parts = [scorer.statistics(texts[i : i + 10]) for i in range(0, len(texts), 10)]
        columns = {c: sum((p[c].to_pylist() for p in parts), []) for c in parts[0]}
        return grams, columns, len(scorer.vocabulary)

    grams, columns, every = run()
    monkeypatch.setattr(perplexity, "FEW_WORDS", 300)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    again, others, few = run()
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert again == grams and few < every
    logs, other = columns.pop("log_perplexity"), others.pop("log_perplexity")
    assert others == columns
    assert np.allclose([x or 0 for x in other], [x or 0 for x in logs])
