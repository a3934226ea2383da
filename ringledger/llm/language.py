"""Language identification by rank-order profiles (Cavnar and Trenkle's method).

A language's profile is its ``PROFILE`` most frequent character n-grams, in order. A text
gets the same kind of list, and each of its n-grams is as far out of place in a profile as
the ranks differ, or as far as possible if the profile lacks it. The language with the
smallest sum wins. Tasks reduce their texts to n-gram counts per language, Spark adds them
up and ranks them. The profiles, PROFILE entries a language, are broadcast.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringledger.llm.rows import Passed
from ringledger.llm.splits import in_fold
from ringledger.llm.words import Vocabulary, slices, utf8

PROFILE = 300
ORDERS = (1, 2, 3)
UNKNOWN = "und"
FOLDS, HELD_OUT_FOLD = 5, 0
_MOST_GRAMS = 1 << 17


class _Grams:
    """N-grams of words as numbers; words and n-grams are numbered as they come."""

    def __init__(self) -> None:
        self.vocabulary = Vocabulary()
        self.numbers: dict[str, int] = {}
        self.flat = np.zeros(0, np.int64)
        self.starts = np.zeros(1, np.int64)
        self.ties = np.zeros(0, np.int64)

    @property
    def full(self) -> bool:
        return self.vocabulary.full or len(self.numbers) > _MOST_GRAMS

    def learn(self) -> None:
        """Spell the words that came since the last call."""
        parts, lengths = [], []
        for word in self.vocabulary.words[len(self.starts) - 1 :]:
            letters = "".join(filter(str.isalpha, word.decode("utf-8", "replace").lower()))
            found = []
            if letters:
                spelled = f"_{letters}_"
                for n in ORDERS:
                    for i in range(len(spelled) - n + 1):
                        gram = spelled[i : i + n]
                        if gram != "_":
                            found.append(self.numbers.setdefault(gram, len(self.numbers)))
            parts.extend(found)
            lengths.append(len(found))
        if lengths:
            self.flat = np.r_[self.flat, np.array(parts, np.int64)]
            self.starts = np.r_[self.starts, self.starts[-1] + np.cumsum(lengths)]
        new = list(self.numbers)[len(self.ties) :]
        self.ties = np.r_[self.ties, np.array([zlib.crc32(g.encode()) for g in new], np.int64)]

    def of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All n-grams of the words in turn, and where each word's start (and the end)."""
        lengths = np.diff(self.starts)[words]
        ends = np.cumsum(lengths)
        first = np.repeat(self.starts[:-1][words] - (ends - lengths), lengths)
        return self.flat[first + np.arange(len(first))], np.r_[0, ends]


def count_ngrams(docs: DataFrame) -> DataFrame:
    """``lang, gram, count`` of the columns ``lang`` and ``text``."""

    def tasks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, counts = _Grams(), {}
        for batch in slices(batches, "text"):
            ids, starts = grams.vocabulary.number(utf8(batch.column("text")))
            grams.learn()
            langs = np.repeat(np.array(batch.column("lang").to_pylist(), object), np.diff(starts))
            for lang in set(batch.column("lang").to_pylist()):
                words, times = np.unique(ids[langs == lang], return_counts=True)
                found, ends = grams.of(words)
                weights = np.repeat(times, np.diff(ends))
                more = np.bincount(found, weights, len(grams.numbers)).astype(np.float64)
                held = counts.get(lang, np.zeros(0))
                more[: len(held)] += held
                counts[lang] = more
            if grams.full:
                yield from _emitted(grams, counts)
                grams, counts = _Grams(), {}
        yield from _emitted(grams, counts)

    counted = docs.mapInArrow(tasks, "lang string, gram string, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("count"))


def _emitted(grams: _Grams, counts: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    names = np.array(list(grams.numbers), object)
    for lang, n in counts.items():
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict(
            {
                "lang": pa.array([lang] * len(some), pa.string()),
                "gram": pa.array(names[some], pa.string()),
                "n": n[some].astype(np.int64),
            }
        )


def profiles(docs: DataFrame, size: int = PROFILE) -> dict[str, list[str]]:
    """Each language's most frequent n-grams, from ``lang`` and ``text``; nulls are skipped."""
    known = docs.where("lang is not null and text is not null")
    by_count = Window.partitionBy("lang").orderBy(F.desc("count"), "gram")
    ranked = count_ngrams(known).withColumn("rank", F.row_number().over(by_count))
    found: dict[str, list[str]] = {}
    for row in ranked.where(F.col("rank") <= size).orderBy("lang", "rank").collect():
        found.setdefault(row["lang"], []).append(row["gram"])
    return found


class _Ranker:
    def __init__(self, known: dict[str, list[str]], size: int) -> None:
        self.langs, self.size = sorted(known), size
        self.known = [known[lang] for lang in self.langs]
        self._clear()

    def _clear(self) -> None:
        self.grams = _Grams()
        for profile in self.known:
            for gram in profile:
                self.grams.numbers.setdefault(gram, len(self.grams.numbers))
        # Grams of no profile, which come later, are as far out of place as can be.
        self.ranks = np.full((len(self.known), len(self.grams.numbers) + 1), self.size, np.int64)
        for row, profile in zip(self.ranks, self.known):
            row[[self.grams.numbers[gram] for gram in profile]] = np.arange(len(profile))

    def best(self, texts: list[bytes]) -> tuple[list[str], list[float]]:
        if self.grams.full:
            self._clear()
        ids, starts = self.grams.vocabulary.number(texts)
        self.grams.learn()
        found, ends = self.grams.of(ids)
        bounds = ends[starts]
        langs, scores = [], []
        for a, b in zip(bounds[:-1], bounds[1:]):
            lang, score = self._best(found[a:b])
            langs.append(lang)
            scores.append(score)
        return langs, scores

    def _best(self, found: np.ndarray) -> tuple[str, float]:
        if not len(found) or not self.langs:
            return UNKNOWN, 0.0
        counts = np.bincount(found)
        some = np.flatnonzero(counts)
        keys = (counts[some] << 32) | self.grams.ties[some]
        if len(some) > self.size:
            top = np.argpartition(-keys, self.size - 1)[: self.size]
            some, keys = some[top], keys[top]
        own = some[np.argsort(-keys, kind="stable")]
        own = np.minimum(own, self.ranks.shape[1] - 1)
        distances = np.abs(self.ranks[:, own] - np.arange(len(own))).sum(axis=1)
        best = int(distances.argmin())
        return self.langs[best], float(1 - distances[best] / (self.size * len(own)))


def identify(
    docs: DataFrame, known: dict[str, list[str]], size: int = PROFILE, text_column: str = "text"
) -> DataFrame:
    """``docs`` without the text, plus ``lang_pred`` and ``score``.

    The score is 1 minus the distance to the chosen profile as a share of the largest
    possible one. A text that is null or has no letter is ``und`` with score 0, and so is
    every text if there is no profile. Of languages equally near, the first by name wins.
    Rows count by themselves, also where ids or rows repeat. Columns of ``docs`` named
    like new ones are replaced.
    """
    new = ["lang_pred", "score"]
    passed = Passed(docs, [c for c in docs.columns if c not in (text_column, *new)])
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def tasks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranker = _Ranker(shared.value, size)
        for batch in slices(batches, "text"):
            langs, scores = ranker.best(utf8(batch.column("text")))
            yield pa.RecordBatch.from_pydict(
                {
                    "row": batch.column("row"),
                    "lang_pred": pa.array(langs, pa.string()),
                    "score": pa.array(scores, pa.float64()),
                }
            )

    ready = docs.select(passed.struct, docs[text_column].alias("text"))
    schema = T.StructType([ready.schema["row"]]).add("lang_pred", "string").add("score", "double")
    named = ready.mapInArrow(tasks, schema)
    return named.select(*passed.all(), *new)


def cross_checked(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
) -> DataFrame:
    """Learn profiles from four folds of ``docs``; identify all, with ``held_out`` for the fifth."""
    held_out = in_fold(docs[id_column], FOLDS, HELD_OUT_FOLD)
    learned = docs.where(~held_out).select(
        docs[lang_column].alias("lang"), docs[text_column].alias("text")
    )
    known = profiles(learned)
    return identify(docs.withColumn("held_out", held_out), known, text_column=text_column)
