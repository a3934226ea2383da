"""Token log-probabilities of whole texts by a log-bilinear neural model.

A token is a class and, within the class, a word. The FREQUENT most frequent words and the
end of a text are classes of their own; other words share SUFFIXES classes by their last
letters. The neural model gives a class's probability after the classes of the two tokens
before it: context embeddings, scaled by position, are added and multiplied with target
embeddings. It is trained in numpy with noise-contrastive estimation on counts of class
triples, which tasks gather from every training text and Spark adds up; there are at most
CLASSES ** 3 of them. Matrix products over all contexts then normalise it. Within a class a
word has its add-one share of the class's counts.

Word counts cover all training texts and stay distributed. Words with at least one token in
``HOT`` are broadcast: since shares add up to 1, there are ``HOT`` of them at most. The
rest of a text's words meet their counts in a join.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringledger.llm.rows import Passed
from ringledger.llm.splits import in_fold
from ringledger.llm.storage import written
from ringledger.llm.words import Vocabulary, slices, sums_between, utf8

FOLDS, HELD_OUT_FOLD = 7, 2
HOT = 2_000_000

FREQUENT, SUFFIXES = 63, 64
#: Class 0 ends a text, and stands for what is before its first word.
CLASSES = 1 + FREQUENT + SUFFIXES

DIMENSIONS, NOISE, BATCH, STEPS, RATE = 32, 64, 2048, 1500, 0.01


# Words.


class _Words:
    """A vocabulary with the hash and the suffix class of each word."""

    def __init__(self) -> None:
        self.vocabulary = Vocabulary()
        self.hashes = np.zeros(0, np.int64)
        self.suffixes = np.zeros(0, np.int64)

    def number(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the lower-cased words, and where texts start; a full one starts anew."""
        if self.vocabulary.full:
            self.__init__()
        ids, starts = self.vocabulary.number([text.lower() for text in texts])
        new = self.vocabulary.words[len(self.hashes) :]
        hashes = np.array([xxhash.xxh64_intdigest(w) for w in new], np.uint64).view(np.int64)
        self.hashes = np.r_[self.hashes, hashes]
        ends = np.array([zlib.crc32(w.rstrip(b".,;:!?")[-3:]) % SUFFIXES for w in new], np.int64)
        self.suffixes = np.r_[self.suffixes, ends + 1 + FREQUENT]
        return ids, starts


def count_words(docs: DataFrame) -> DataFrame:
    """``hash, suffix, n`` of the words of the column ``text``."""

    def tasks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts = _Words(), np.zeros(0, np.int64)
        for batch in slices(batches, "text"):
            if words.vocabulary.full:
                yield _word_counts(words, counts)
                counts = np.zeros(0, np.int64)
            ids, _ = words.number(utf8(batch.column("text")))
            more = np.bincount(ids, minlength=len(words.hashes))
            more[: len(counts)] += counts
            counts = more
        yield _word_counts(words, counts)

    counted = docs.mapInArrow(tasks, "hash long, suffix int, n long")
    return counted.groupBy("hash").agg(F.first("suffix").alias("suffix"), F.sum("n").alias("n"))


def _word_counts(words: _Words, counts: np.ndarray) -> pa.RecordBatch:
    columns = {"hash": words.hashes, "suffix": words.suffixes.astype(np.int32), "n": counts}
    return pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in columns.items()})


@dataclass
class Lexicon:
    """What scoring needs to know of words: bounded by HOT, whatever the corpus."""

    tokens: int
    distinct: int
    texts: int
    hot: np.ndarray  # ascending hashes
    hot_counts: np.ndarray
    frequent: dict[int, int]  # class by hash
    class_sizes: np.ndarray  # counts plus distinct words plus one, by class


def lexicon(counts: DataFrame, texts: int) -> Lexicon:
    """From ``count_words`` of ``texts`` texts."""
    words, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    tokens = words + texts
    hot = counts.where(F.col("n") * HOT >= tokens).select("hash", "n").toArrow()
    hashes, n = hot.column("hash").to_numpy(), hot.column("n").to_numpy()
    top = np.lexsort((hashes, -n))[:FREQUENT]
    frequent = {int(h): i + 1 for i, h in enumerate(hashes[top])}
    sizes = np.ones(CLASSES)
    rest = counts.where(~F.col("hash").isin(list(frequent))) if frequent else counts
    by_class = rest.groupBy("suffix").agg((F.sum("n") + F.count(F.lit(1)) + 1).alias("size"))
    for row in by_class.collect():  # a row for each suffix class
        sizes[row["suffix"]] = row["size"]
    order = np.argsort(hashes)
    distinct += texts > 0
    return Lexicon(tokens, distinct, texts, hashes[order], n[order], frequent, sizes)


class _Classes:
    """Classes and hot counts of the words of a task."""

    def __init__(self, lexicon: Lexicon) -> None:
        self.lexicon, self.words = lexicon, _Words()
        self._clear()

    def _clear(self) -> None:
        self.classes, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def number(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if self.words.vocabulary.full:
            self._clear()
        ids, starts = self.words.number(texts)
        hashes = self.words.hashes[len(self.classes) :]
        if len(hashes):
            known, frequent = self.lexicon, self.lexicon.frequent
            classes = self.words.suffixes[len(self.classes) :].copy()
            for i, h in enumerate(hashes.tolist()):
                classes[i] = frequent.get(h, classes[i])
            counts = np.full(len(hashes), -1)  # unknown here: the join has it
            if len(known.hot):
                at = np.minimum(np.searchsorted(known.hot, hashes), len(known.hot) - 1)
                counts = np.where(known.hot[at] == hashes, known.hot_counts[at], -1)
            self.classes = np.r_[self.classes, classes]
            self.counts = np.r_[self.counts, counts]
        return ids, starts

    def contexts(self, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of (class before last, last class, class) of every token with the ends of
        texts, and where each text starts in them."""
        n = np.diff(starts)
        bounds = starts + np.arange(len(starts))
        line = np.zeros(bounds[-1], np.int64)
        line[np.arange(len(ids)) + np.repeat(np.arange(len(n)), n)] = self.classes[ids]
        place = np.arange(len(line)) - np.repeat(bounds[:-1], n + 1)
        last = np.where(place > 0, np.r_[0, line[:-1]], 0)
        before = np.where(place > 1, np.r_[0, 0, line[:-2]][: len(line)], 0)
        return (before * CLASSES + last) * CLASSES + line, bounds


def count_triples(docs: DataFrame, lexicon: Lexicon) -> np.ndarray:
    """How often each triple of classes occurs in the texts, of CLASSES ** 3."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def tasks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, counts = _Classes(shared.value), np.zeros(CLASSES**3, np.int64)
        for batch in slices(batches, "text"):
            triples, _ = classes.contexts(*classes.number(utf8(batch.column("text"))))
            counts += np.bincount(triples, minlength=len(counts))
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"triple": some.astype(np.int32), "n": counts[some]})

    summed = docs.mapInArrow(tasks, "triple int, n long").groupBy("triple").agg(F.sum("n").alias("n"))
    rows = summed.toArrow()
    counts = np.zeros(CLASSES**3, np.int64)
    counts[rows.column("triple").to_numpy()] = rows.column("n").to_numpy()
    return counts


# The neural model.


class LogBilinear:
    def __init__(self, seed: int = 7) -> None:
        self.random = np.random.default_rng(seed)
        shape = (CLASSES, DIMENSIONS)
        self.weights = {
            "context": self.random.normal(0, 0.1, shape),
            "target": self.random.normal(0, 0.1, shape),
            "near": np.ones(DIMENSIONS),
            "far": np.full(DIMENSIONS, 0.5),
            "bias": np.zeros(CLASSES),
        }
        self.weights = {name: value.astype(np.float32) for name, value in self.weights.items()}

    def train(self, counts: np.ndarray) -> None:
        """Noise-contrastive estimation: tell drawn triples from noise classes.

        Batches are drawn by the counts. The noise follows the frequency of classes, and a
        batch shares its draws, so that their scores are one matrix product.
        """
        total = counts.sum()
        if not total:
            return
        some = np.flatnonzero(counts)
        ladder = np.cumsum(counts[some]) / total
        share = np.bincount(some % CLASSES, counts[some], CLASSES) + 1
        share /= share.sum()
        noise_ladder, log_noise = np.cumsum(share), np.log(NOISE * share).astype(np.float32)
        self.weights["bias"] = np.log(share).astype(np.float32)
        means = {k: np.zeros_like(v) for k, v in self.weights.items()}
        squares = {k: np.zeros_like(v) for k, v in self.weights.items()}
        for step in range(1, STEPS + 1):
            drawn = some[np.minimum(np.searchsorted(ladder, self.random.random(BATCH)), len(some) - 1)]
            noise = np.searchsorted(noise_ladder, self.random.random(NOISE))
            noise = np.minimum(noise, CLASSES - 1)
            gradients = self._gradients(drawn, noise, log_noise)
            rate = RATE * (1 - step / (STEPS + 1))
            for name, gradient in gradients.items():  # Adam
                means[name] = 0.9 * means[name] + 0.1 * gradient
                squares[name] = 0.999 * squares[name] + 0.001 * gradient**2
                mean, square = means[name] / (1 - 0.9**step), squares[name] / (1 - 0.999**step)
                step_size = rate * mean / (np.sqrt(square) + 1e-8)
                self.weights[name] += step_size.astype(np.float32)

    def _gradients(self, drawn: np.ndarray, noise: np.ndarray, log_noise: np.ndarray) -> dict:
        w = self.weights
        target, last, before = drawn % CLASSES, drawn // CLASSES % CLASSES, drawn // CLASSES**2
        near, far = w["context"][last], w["context"][before]
        guess = near * w["near"] + far * w["far"]
        true = (guess * w["target"][target]).sum(axis=1) + w["bias"][target] - log_noise[target]
        false = guess @ w["target"][noise].T + w["bias"][noise] - log_noise[noise]
        up = 1 / (1 + np.exp(np.clip(true, -30, 30))) / len(drawn)
        down = -1 / (1 + np.exp(np.clip(-false, -30, 30))) / len(drawn)
        to_guess = up[:, None] * w["target"][target] + down @ w["target"][noise]
        out = {name: np.zeros_like(value) for name, value in w.items()}
        np.add.at(out["target"], target, up[:, None] * guess)
        np.add.at(out["target"], noise, down.T @ guess)
        np.add.at(out["bias"], target, up)
        np.add.at(out["bias"], noise, down.sum(axis=0))
        np.add.at(out["context"], last, to_guess * w["near"])
        np.add.at(out["context"], before, to_guess * w["far"])
        out["near"], out["far"] = (to_guess * near).sum(axis=0), (to_guess * far).sum(axis=0)
        return out

    def log10_probabilities(self) -> np.ndarray:
        """For every context and class, normalised, by the number of the triple."""
        w, rows = {name: value.astype(np.float64) for name, value in self.weights.items()}, []
        for before in range(CLASSES):
            guess = w["context"] * w["near"] + w["context"][before] * w["far"]
            scores = guess @ w["target"].T + w["bias"]
            scores -= scores.max(axis=1, keepdims=True)
            scores -= np.log(np.exp(scores).sum(axis=1, keepdims=True))
            rows.append(scores / np.log(10))
        return np.concatenate(rows).ravel().astype(np.float32)


# The operator.

_PARTIAL = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("known", T.LongType()),
        T.StructField("logs", T.DoubleType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("hashes", T.ArrayType(T.LongType())),
        T.StructField("times", T.ArrayType(T.IntegerType())),
    ]
)


def _partial_scores(docs: DataFrame, lexicon: Lexicon, table: np.ndarray) -> DataFrame:
    """``row`` and, by document, sums over the tokens with known counts and the other words.

    ``logs`` sums log10(count + 1) of all tokens, ``score`` the model's log10 probability
    but for that term of words that share a class.
    """
    shared = docs.sparkSession.sparkContext.broadcast((lexicon, table))

    def tasks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, probabilities = shared.value
        classes, end = _Classes(known), np.log10(known.texts + 1)
        within = np.log10(known.class_sizes)
        for batch in slices(batches, "text"):
            ids, starts = classes.number(utf8(batch.column("text")))
            triples, bounds = classes.contexts(ids, starts)
            counts = classes.counts[ids]
            logs = np.log10(np.maximum(counts, 0) + 1)
            single = classes.classes[ids] <= FREQUENT
            score = sums_between(probabilities[triples].astype(np.float64), bounds)
            inside = np.where(single, 0, logs - within[classes.classes[ids]])
            rare = counts < 0
            hashes, times = _rare(classes.words.hashes, ids, rare, starts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("held_out"),
                    pa.array(np.diff(starts) + 1),
                    pa.array(sums_between((~rare).astype(np.int64), starts) + int(known.texts > 0)),
                    pa.array(sums_between(logs, starts) + end),
                    pa.array(score + sums_between(inside, starts)),
                    hashes,
                    times,
                ],
                ["row", "held_out", *_PARTIAL.names],
            )

    schema = T.StructType([docs.schema["row"], docs.schema["held_out"], *_PARTIAL.fields])
    return docs.mapInArrow(tasks, schema)


def _rare(
    hashes: np.ndarray, ids: np.ndarray, rare: np.ndarray, starts: np.ndarray
) -> tuple[pa.Array, pa.Array]:
    """Distinct rare words of each text and how often they occur."""
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))[rare]
    keys, times = np.unique((owner << 32) | ids[rare], return_counts=True)
    offsets = np.searchsorted(keys >> 32, np.arange(len(starts))).astype(np.int32)
    words = hashes[keys & 0xFFFFFFFF]
    return (
        pa.ListArray.from_arrays(offsets, pa.array(words, pa.int64())),
        pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32))),
    )


def score(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` without the text, plus token counts, ``base_score`` and ``score``.

    Learns from texts that are not held out. ``base_score`` is the add-one unigram log10
    probability of a text's tokens, ``score`` that of the model. Every text ends with an
    end token, so a null or empty text has just that one. Without training texts counts
    are zero and the model is the one it starts from. Rows count by themselves, also where
    ids or rows repeat; a null id is never held out. Columns of ``docs`` named like new
    ones are replaced.
    """
    new = ["held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    passed = Passed(docs, [c for c in docs.columns if c not in (text_column, *new)])
    held_out = in_fold(docs[id_column], FOLDS, HELD_OUT_FOLD)
    training = docs.where(~held_out).select(docs[text_column].alias("text"))
    counts = written(count_words(training), "words")
    known = lexicon(counts, training.count())
    model = LogBilinear()
    model.train(count_triples(training, known))

    ready = docs.select(passed.struct, held_out.alias("held_out"), docs[text_column].alias("text"))
    partial = _partial_scores(ready, known, model.log10_probabilities())
    # The id of a row is written with it, so it is the same wherever it is read.
    partial = written(partial.withColumn("key", F.monotonically_increasing_id()), "partial")
    pairs = F.arrays_zip("hashes", "times")
    rare = (
        partial.select("key", F.explode(pairs).alias("pair"))
        .select("key", F.col("pair.hashes").alias("hash"), "pair.times")
        .join(counts.select("hash", "n"), "hash")
        .groupBy("key")
        .agg(
            F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("more_logs"),
            F.sum("times").alias("more_known"),
        )
    )
    joined = partial.drop("hashes", "times").join(rare, "key", "left")
    more = F.coalesce("more_logs", F.lit(0.0))
    every = float(np.log10(known.tokens + known.distinct + 1))
    return joined.select(
        *passed.all(),
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(known.tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + more - F.col("n_tokens") * every).alias("base_score"),
        (F.col("score") + more).alias("score"),
    )
