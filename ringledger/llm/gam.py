"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature of a text has a lookup table over its bins, and so has each of a few pairs of
features; a text's log-odds are the sum of the entries it falls into. The tables are
learned by boosting that goes round the features: each step fits a tree of at most four
leaves to the current gradients of one feature, or of one pair, and adds a small share of
it. Features of all texts come from one pass in tasks; the model is fitted in numpy on at
most ``MAX_ROWS`` labelled rows, those with the smallest hash of their id.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringledger.llm.rows import Passed
from ringledger.llm.splits import in_fold
from ringledger.llm.storage import written
from ringledger.llm.words import (
    WHITE,
    Vocabulary,
    repeated_lines,
    repeated_words,
    slices,
    utf8,
)

MAX_ROWS = 20_000
FOLDS, HELD_OUT_FOLD = 3, 1

BINS, PAIR_BINS, PAIRS = 32, 8, 8
ROUNDS, PAIR_ROUNDS, RATE = 120, 40, 0.1
#: Added to the curvature of a leaf, so that few rows move a table little.
SMOOTHING = 2.0

FEATURES = [
    "log_words", "log_bytes_per_word", "distinct_share", "repeated_window_share",
    "repeated_line_share", "log_words_per_line", "symbols", "digits", "upper", "lower",
    "stops", "commas", "exclamations", "other_marks", "wide", "pipes", "entropy", "control",
]


# Features.


def _classes() -> np.ndarray:
    """Which byte counts for which class, as a matrix."""
    groups = {
        "symbols": b"#*$%&<>", "digits": b"0123456789", "upper": bytes(range(65, 91)),
        "lower": bytes(range(97, 123)), "stops": b".?;:", "commas": b",", "exclamations": b"!",
        "other_marks": b"\"'()[]{}-_=+/\\@^~`", "wide": bytes(range(0xC0, 0x100)), "pipes": b"|",
        "control": bytes(set(range(32)) - set(WHITE)),
    }
    matrix = np.zeros((256, len(FEATURES)))
    for name, members in groups.items():
        matrix[list(members), FEATURES.index(name)] = 1
    return matrix


class Features:
    def __init__(self) -> None:
        self.vocabulary, self.classes = Vocabulary(), _classes()

    def of(self, texts: list[bytes]) -> np.ndarray:
        """A row of FEATURES for each text; an empty text has zeros."""
        if self.vocabulary.full:
            self.vocabulary = Vocabulary()
        ids, starts = self.vocabulary.number(texts)
        words = np.diff(starts)
        histograms = np.zeros((len(texts), 256))
        for row, text in zip(histograms, texts):
            row[:] = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
        bytes_ = histograms.sum(axis=1)
        lines = histograms[:, 10] + 1
        white = histograms[:, list(WHITE)].sum(axis=1)
        share = histograms / np.maximum(bytes_, 1)[:, None]
        out = share @ self.classes
        some = np.maximum(words, 1)
        distinct = [len(np.unique(ids[a:b])) for a, b in zip(starts[:-1], starts[1:])]
        put = {
            "log_words": np.log1p(words),
            "log_bytes_per_word": np.log1p((bytes_ - white) / some),
            "distinct_share": np.array(distinct) / some,
            "repeated_window_share": repeated_words(ids, starts) / some,
            "repeated_line_share": np.array([repeated_lines(t) for t in texts]) / lines,
            "log_words_per_line": np.log1p(words / lines),
            "entropy": -(share * np.log(np.maximum(share, 1e-12))).sum(axis=1),
        }
        for name, values in put.items():
            out[:, FEATURES.index(name)] = values
        return out.astype(np.float32)


def with_features(docs: DataFrame) -> DataFrame:
    """``row`` and ``features`` from ``row`` and ``text``."""

    def tasks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in slices(batches, "text"):
            values = features.of(utf8(batch.column("text")))
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(values) + 1) * len(FEATURES), pa.int32()), values.ravel()
            )
            yield pa.RecordBatch.from_arrays([batch.column("row"), lists], ["row", "features"])

    schema = T.StructType([docs.schema["row"]]).add("features", T.ArrayType(T.FloatType()))
    return docs.mapInArrow(tasks, schema)


# Model.


@dataclass
class Gam:
    edges: list[np.ndarray]
    coarse: list[np.ndarray]
    intercept: float = 0.0
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        """Sums of table entries for the rows of ``x``."""
        total = np.full(len(x), self.intercept)
        for values, edges, table in zip(x.T, self.edges, self.tables):
            total += table[np.searchsorted(edges, values)]
        for i, j, table in self.pairs:
            a = np.searchsorted(self.coarse[i], x[:, i])
            total += table[a, np.searchsorted(self.coarse[j], x[:, j])]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(x), -30, 30)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins)) if len(values) else np.zeros(0)


def fit(x: np.ndarray, y: np.ndarray) -> Gam:
    """Learn from features and labels 0 or 1. Without rows every score is one half."""
    model = Gam([_edges(v, BINS) for v in x.T], [_edges(v, PAIR_BINS) for v in x.T])
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    rate = (y.sum() + 1) / (len(y) + 2)
    model.intercept = float(np.log(rate / (1 - rate)))
    bins = [np.searchsorted(e, v) for e, v in zip(model.edges, x.T)]
    odds = np.full(len(y), model.intercept)

    def gradients(cells: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-odds))
        return np.bincount(cells, y - p, size), np.bincount(cells, p * (1 - p), size)

    for _ in range(ROUNDS):
        for cells, table in zip(bins, model.tables):
            step = RATE * _tree(*gradients(cells, len(table)))
            table += step
            odds += step[cells]

    coarse = [np.searchsorted(e, v) for e, v in zip(model.coarse, x.T)]
    shapes = [len(e) + 1 for e in model.coarse]
    gains = []
    for i in range(len(shapes)):
        for j in range(i):
            size = shapes[i] * shapes[j]
            g, h = gradients(coarse[i] * shapes[j] + coarse[j], size)
            tree = _pair_tree(g.reshape(shapes[i], -1), h.reshape(shapes[i], -1))
            gains.append(((g * tree.ravel()).sum(), i, j))
    for _, i, j in sorted(gains, reverse=True)[:PAIRS]:
        model.pairs.append((i, j, np.zeros((shapes[i], shapes[j]))))
    for _ in range(PAIR_ROUNDS):
        for i, j, table in model.pairs:
            cells = coarse[i] * shapes[j] + coarse[j]
            g, h = gradients(cells, table.size)
            step = RATE * _pair_tree(g.reshape(table.shape), h.reshape(table.shape))
            table += step
            odds += step.ravel()[cells]
    return model


def _cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Best gain of a cut between bins, and how many bins lie before it."""
    if len(g) < 2:
        return 0.0, 0
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    right_g, right_h = g.sum() - left_g, h.sum() - left_h
    gain = left_g**2 / (left_h + SMOOTHING) + right_g**2 / (right_h + SMOOTHING)
    gain -= g.sum() ** 2 / (h.sum() + SMOOTHING)
    best = int(gain.argmax())
    return float(gain[best]), best + 1


def _leaf(g: np.ndarray, h: np.ndarray) -> float:
    return float(g.sum() / (h.sum() + SMOOTHING))


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Values by bin of a tree of depth two."""
    values = np.full(len(g), _leaf(g, h))
    gain, at = _cut(g, h)
    if gain > 0:
        for part in (slice(0, at), slice(at, None)):
            inner, middle = _cut(g[part], h[part])
            values[part] = _leaf(g[part], h[part])
            if inner > 0:
                start = part.start
                values[start : start + middle] = _leaf(g[part][:middle], h[part][:middle])
                values[start + middle : part.stop] = _leaf(g[part][middle:], h[part][middle:])
    return values


def _pair_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Values by cell of a tree that cuts one feature, and then each side on the other."""
    best_gain, best = -1.0, np.zeros_like(g)
    for flip in (False, True):
        a, b = (g.T, h.T) if flip else (g, h)
        for at in range(1, len(a)):
            values, gain = np.zeros_like(a), 0.0
            for part in (slice(0, at), slice(at, None)):
                side_g, side_h = a[part].sum(axis=0), b[part].sum(axis=0)
                _, middle = _cut(side_g, side_h)
                for side in (slice(0, middle), slice(middle, None)):
                    values[part, side] = leaf = _leaf(side_g[side], side_h[side])
                    gain += leaf * side_g[side].sum()
            if gain > best_gain:
                best_gain, best = gain, values.T if flip else values
    return best


# The operator.


def classify(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """``docs`` without the text, plus ``held_out``, ``score`` and ``predicted``.

    Learns from labels 0 and 1 of documents that are not held out; other labels and null
    ids are skipped, and a document with several labels counts with each. Null and empty
    texts get the score that such features have. Without labels every score is one half,
    and an empty table gives an empty table. Rows count by themselves, also where ids or
    rows repeat. Columns of ``docs`` named like new ones are replaced.
    """
    new = ["held_out", "score", "predicted"]
    passed = Passed(docs, [c for c in docs.columns if c not in (text_column, *new)])
    rows = docs.select(passed.struct, docs[text_column].alias("text"))
    table = written(with_features(rows), "features")
    key = passed.get(id_column)
    held_out = in_fold(key, FOLDS, HELD_OUT_FOLD)
    known = labels.select(labels[id_column].alias("id"), labels[label_column].alias("label"))
    sample = (
        table.where(~held_out)
        .select(key.alias("id"), "features")
        .join(known.where("label in (0, 1)"), "id")
        .orderBy(F.xxhash64("id"), "id", "features", "label")
        .limit(max_rows)
        .toPandas()
    )
    x = np.array(sample["features"].tolist(), np.float32).reshape(-1, len(FEATURES))
    model = fit(x, sample["label"].to_numpy(np.float64))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(features: pd.Series) -> pd.Series:
        rows = np.array(features.tolist(), np.float32).reshape(-1, len(FEATURES))
        return pd.Series(shared.value.probability(rows))

    scored = table.select("row", held_out.alias("held_out"), score("features").alias("score"))
    predicted = F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    return scored.select(*passed.all(), "held_out", "score", predicted)
