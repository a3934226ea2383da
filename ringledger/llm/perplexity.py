"""Quality rules: plain text statistics, then bands of n-gram perplexity per language.

The model predicts each character of a word from up to four characters before it, within
the word, by interpolated modified Kneser-Ney estimates. One model is learned from all
texts; the perplexity is that of a word, and the bands are those of a language. Tasks
reduce their texts to counts of character n-grams, Spark adds these up and derives the
lower orders by counting distinct left neighbours, and the estimates go into sorted arrays
of 64-bit hashes, 12 bytes for each distinct n-gram, which are broadcast. The arrays grow
with the n-grams, so an n-gram that was never counted is never taken for another.

Characters within words, not words, because their n-grams stay few as the corpus grows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringledger.functions.skew import spread_join
from ringledger.llm.rows import Passed
from ringledger.llm.storage import written
from ringledger.llm.words import (
    FEW_WORDS,
    WHITE,
    Vocabulary,
    mix,
    repeated_lines,
    repeated_words,
    slices,
    sums_between,
    utf8,
)

ORDER = 5
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A text is rejected beyond the middle of its language's shortest half plus or minus so
#: many times half its width, or LEAST_SPREAD if that is larger. In natural logs per word.
FENCE = 4.5
LEAST_SPREAD = 0.125

_START, _END = "\x02", "\x03"
_SYMBOLS = b"#*$%&|<>"
#: A text that more than one in so many rows hold counts once in the model.
COPIED = 1000
#: Words spelled at once, which bounds a task's arrays.
_BLOCK_WORDS = 1 << 16
#: Where a language is null it counts as this one.
_NO_LANGUAGE = ""


# Counting.


def count_ngrams(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``gram, count``: each character with up to ORDER - 1 before it in its word."""

    def tasks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, counts = Vocabulary(FEW_WORDS), np.zeros(0, np.int64)
        for batch in slices(batches, "text"):
            ids, _ = vocabulary.number(utf8(batch.column("text")))
            counts = _added(counts, ids, len(vocabulary.words))
            if vocabulary.full:
                often = vocabulary.frequent(counts)
                rare = vocabulary.only(~often).words
                yield _grams(rare, counts[~often])
                vocabulary, counts = vocabulary.only(often), counts[often]
        if len(counts):
            yield _grams(vocabulary.words, counts)

    counts = docs.select(docs[text_column].alias("text")).mapInArrow(tasks, "gram string, n long")
    return counts.groupBy("gram").agg(F.sum("n").alias("count"))


def _added(counts: np.ndarray, ids: np.ndarray, size: int) -> np.ndarray:
    """``counts`` and how often each id occurs, for ``size`` ids."""
    more = np.bincount(ids, minlength=size)
    more[: len(counts)] += counts
    return more


def _spelled(words: list[bytes]) -> tuple[str, np.ndarray, np.ndarray]:
    """All words with their marks in one string, its code points, and where each starts."""
    parts = [_START + word.decode("utf-8", "replace") + _END for word in words]
    text = "".join(parts)
    starts = np.cumsum([0, *map(len, parts)])
    return text, np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32), starts


def _places(starts: np.ndarray) -> np.ndarray:
    """Each character's place in its word, from 0."""
    return np.arange(starts[-1]) - np.repeat(starts[:-1], np.diff(starts))


def _grams(words: list[bytes], counts: np.ndarray) -> pa.RecordBatch:
    blocks = []
    for start in range(0, len(words), _BLOCK_WORDS):
        part = slice(start, start + _BLOCK_WORDS)
        blocks.append(_block_grams(words[part], counts[part]))
    hashes, n, grams = (np.concatenate(x) for x in zip(*blocks))
    _, first, group = np.unique(hashes, return_index=True, return_inverse=True)
    n = np.bincount(group, n, len(first)).astype(np.int64)
    return pa.RecordBatch.from_pydict({"gram": pa.array(grams[first], pa.string()), "n": n})


def _block_grams(words: list[bytes], counts: np.ndarray):
    """Hashes, counts and strings of the distinct n-grams."""
    text, codes, starts = _spelled(words)
    places = _places(starts)
    hashes = np.zeros(len(codes), np.uint64)
    for back in range(ORDER - 1, -1, -1):
        hashes = mix(hashes ^ np.where(places >= back, _back(codes, back) + 1, 0).astype(np.uint64))
    predicted = np.flatnonzero(places > 0)
    weights = np.repeat(counts, np.diff(starts))[predicted]
    distinct, first, group = np.unique(hashes[predicted], return_index=True, return_inverse=True)
    ends = predicted[first]
    begins = ends - np.minimum(places[ends], ORDER - 1)
    grams = [text[a : b + 1] for a, b in zip(begins.tolist(), ends.tolist())]
    return distinct, np.bincount(group, weights, len(first)), np.array(grams, object)


def _back(codes: np.ndarray, by: int) -> np.ndarray:
    return np.r_[np.zeros(by, codes.dtype), codes[: len(codes) - by]] if by else codes


# Estimates.


def estimates(counts: DataFrame) -> DataFrame:
    """``part, key, value``: the model, a row for each distinct n-gram and context.

    Part m (1 to ORDER) holds the discounted share of each n-gram of m characters, part
    -m the weight that its context leaves to the next lower order.
    """
    parts = []
    level = counts.where(F.char_length("gram") == ORDER)
    for m in range(ORDER, 0, -1):
        parts.append(_order(level, m))
        if m > 1:
            longer = level.groupBy(F.substring("gram", 2, m).alias("gram")).agg(
                F.count(F.lit(1)).alias("count")
            )
            # What starts a word has no left neighbour, so its plain counts stand in.
            begin = counts.where((F.char_length("gram") == m - 1) & F.col("gram").startswith(_START))
            level = longer.unionByName(begin)
            # Written, or each order would count the ones above it again.
            level = written(longer if m == 2 else level, f"ngrams-{m - 1}")
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)

    def keyed(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield pd.DataFrame(
                    {"part": batch["part"], "key": _keys_of(batch["gram"]), "value": batch["value"]}
                )

    return whole.mapInPandas(keyed, "part byte, key long, value float")


def _order(level: DataFrame, m: int) -> DataFrame:
    level = level.withColumn("context", F.expr(f"substring(gram, 1, {m - 1})"))

    def ones(n: int):
        return F.sum(F.when(F.col("count") == n, 1).otherwise(0))

    contexts = level.groupBy("context").agg(
        F.sum("count").alias("total"),
        ones(1).alias("n1"),
        ones(2).alias("n2"),
        F.sum(F.when(F.col("count") > 2, 1).otherwise(0)).alias("n3"),
    )
    rare = level.agg(*(ones(i).alias(f"t{i}") for i in (1, 2, 3, 4)))
    y = F.col("t1") / F.greatest(F.col("t1") + 2 * F.col("t2"), F.lit(1))

    def discount(i: int):
        usual = i - (i + 1) * y * F.col(f"t{i + 1}") / F.greatest(F.col(f"t{i}"), F.lit(1))
        return F.greatest(F.lit(0.1), F.least(F.lit(float(i)), usual)).alias(f"d{i}")

    # The discounts are one row, so this join copies that row and pairs nothing.
    discounts = F.broadcast(rare.select(discount(1), discount(2), discount(3)))
    level = level.join(contexts, "context").crossJoin(discounts)
    own = F.when(F.col("count") == 1, F.col("d1")).when(F.col("count") == 2, F.col("d2"))
    share = F.greatest(F.lit(0.0), F.col("count") - own.otherwise(F.col("d3"))) / F.col("total")
    left = (
        F.col("d1") * F.col("n1") + F.col("d2") * F.col("n2") + F.col("d3") * F.col("n3")
    ) / F.col("total")
    terms = level.select(F.lit(m).alias("part"), "gram", share.alias("value"))
    weights = contexts.crossJoin(discounts).select(
        F.lit(-m).alias("part"), F.col("context").alias("gram"), left.alias("value")
    )
    return terms.unionByName(weights)


def _keys_of(grams: pd.Series) -> np.ndarray:
    out = np.zeros(len(grams), np.int64)
    lengths = grams.str.len().to_numpy()
    for m in np.unique(lengths):
        own = np.flatnonzero(lengths == m)
        text = "".join(grams.iloc[own])
        codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).reshape(len(own), m)
        hashes = np.zeros(len(own), np.uint64)
        for j in range(m):
            hashes = _extended(hashes, codes[:, j])
        out[own] = hashes.view(np.int64)
    return out


def _extended(hashes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return mix(hashes ^ (codes.astype(np.uint64) + np.uint64(1)))


class Model:
    """Sorted keys and values by part; see ``estimates``."""

    def __init__(self, parts: dict[int, tuple[np.ndarray, np.ndarray]]) -> None:
        self.parts = parts

    @classmethod
    def fit(cls, docs: DataFrame, text_column: str = "text") -> Model:
        counts = written(count_ngrams(docs, text_column), "ngrams")
        rows = estimates(counts).toArrow()
        part, key, value = (rows.column(c).to_numpy() for c in ("part", "key", "value"))
        # A text may hold the marks themselves; of two equal n-grams the larger value is first.
        order = np.lexsort((-value, key, part))
        part, key, value = part[order], key[order], value[order]
        return cls({int(p): (key[part == p], value[part == p]) for p in np.unique(part)})

    def _found(self, part: int, hashes: np.ndarray, default: float) -> np.ndarray:
        keys, values = self.parts.get(part, (np.zeros(0, np.int64), np.zeros(0, np.float32)))
        if not len(keys):
            return np.full(len(hashes), default, np.float32)
        wanted = hashes.view(np.int64)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[at] == wanted, values[at], np.float32(default))

    def log_probabilities(self, words: list[bytes]) -> np.ndarray:
        """Natural log probability of each word with its end."""
        _, codes, starts = _spelled(words)
        places = _places(starts)
        at = np.flatnonzero(places > 0)
        probability = np.full(len(at), 1 / 0x110000, np.float64)
        for m in range(1, ORDER + 1):
            fits = places[at] >= m - 1
            here = at[fits]
            context = np.zeros(len(here), np.uint64)
            for back in range(m - 1, 0, -1):
                context = _extended(context, codes[here - back])
            whole = _extended(context, codes[here])
            weight = self._found(-m, context, 1.0)
            probability[fits] = self._found(m, whole, 0.0) + weight * probability[fits]
        logs = np.zeros(len(codes))
        logs[at] = np.log(np.maximum(probability, 1e-12))
        return sums_between(logs, starts)


# Scoring.

_STATS = {
    "n_words": "long",
    "word_chars": "long",
    "n_symbols": "long",
    "n_dup_lines": "long",
    "n_repeat_words": "long",
    "log_perplexity": "double",
}


def score(rows: DataFrame, model: Model, keep_text: bool = True) -> DataFrame:
    """``row, lang, same, text`` with the statistics; log_perplexity is null without words."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    kept = ["row", "lang", "same", "text"] if keep_text else ["row", "lang", "same"]

    def tasks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(shared.value)
        for batch in slices(batches, "text"):
            columns = scorer.statistics(utf8(batch.column("text")))
            passed = {name: batch.column(name) for name in kept}
            yield pa.RecordBatch.from_pydict(passed | columns)

    schema = T.StructType([rows.schema[name] for name in kept])
    for name, kind in _STATS.items():
        schema.add(name, kind)
    return rows.mapInArrow(tasks, schema)


class _Scorer:
    def __init__(self, model: Model) -> None:
        self.model = model
        self.vocabulary, self.logs = Vocabulary(FEW_WORDS), np.zeros(0)
        self.counts = np.zeros(0, np.int64)

    def _make_room(self) -> None:
        often = self.vocabulary.frequent(self.counts)
        self.vocabulary = self.vocabulary.only(often)
        self.logs, self.counts = self.logs[often], self.counts[often]

    def statistics(self, texts: list[bytes]) -> dict[str, pa.Array]:
        if self.vocabulary.full:
            self._make_room()
        ids, starts = self.vocabulary.number(texts)
        self.counts = _added(self.counts, ids, len(self.vocabulary.words))
        while new := self.vocabulary.words[len(self.logs) :][:_BLOCK_WORDS]:
            self.logs = np.concatenate([self.logs, self.model.log_probabilities(new)])
        n = np.diff(starts)
        per_word = -sums_between(self.logs[ids], starts) / np.maximum(n, 1)
        return {
            "n_words": pa.array(n),
            "word_chars": pa.array([_word_chars(t) for t in texts], pa.int64()),
            "n_symbols": pa.array([_removed(t, _SYMBOLS) for t in texts], pa.int64()),
            "n_dup_lines": pa.array([repeated_lines(t) for t in texts], pa.int64()),
            "n_repeat_words": pa.array(repeated_words(ids, starts)),
            "log_perplexity": pa.array(per_word, mask=n == 0),
        }


def _removed(text: bytes, letters: bytes) -> int:
    return len(text) - len(text.translate(None, letters))


def _word_chars(text: bytes) -> int:
    """Code points outside white space: bytes that don't continue a character."""
    return len(text.translate(None, WHITE + bytes(range(0x80, 0xC0))))


# The rules.


def _copied_once(rows: DataFrame) -> DataFrame:
    """``same, text`` of all rows, but once for a text that a large share of them holds."""
    counts = rows.groupBy("same").agg(F.count(F.lit(1)).alias("n"))
    counts = written(counts.where("n > 1"), "copies")
    copied = counts.where(F.col("n") * COPIED > rows.count()).select("same")
    if copied.isEmpty():
        return rows
    copied = F.broadcast(copied)  # fewer than COPIED rows, as shares add up to 1
    others = rows.join(copied, "same", "left_anti")
    once = rows.join(copied, "same", "left_semi").groupBy("same").agg(F.first("text").alias("text"))
    return others.unionByName(once)


def bands(scored: DataFrame, fence: float) -> DataFrame:
    """``lang, lower, upper`` for each language, null where no text passes the base rules."""
    texts = scored.groupBy("lang", "same").agg(
        F.min(F.when(~F.col("base_failed"), F.col("log_perplexity"))).alias("log_perplexity")
    )
    percents = [i / 100 for i in range(101)]
    quantiles = F.percentile_approx("log_perplexity", percents, 10000)
    halves = F.transform(
        F.sequence(F.lit(0), F.lit(50)),
        lambda i: F.struct(
            (F.get("q", i + 50) - F.get("q", i)).alias("width"), F.get("q", i).alias("low")
        ),
    )
    half = texts.groupBy("lang").agg(quantiles.alias("q")).select(
        "lang", F.when(F.col("q").isNotNull(), F.array_min(halves)).alias("half")
    )
    middle = F.col("half.low") + F.col("half.width") / 2
    spread = fence * F.greatest(F.lit(LEAST_SPREAD), F.col("half.width") / 2)
    return half.select("lang", (middle - spread).alias("lower"), (middle + spread).alias("upper"))


def quality_rules(
    docs: DataFrame,
    fence: float = FENCE,
    text_column: str = "text",
    lang_column: str = "lang",
    keep_text: bool = True,
) -> DataFrame:
    """All rows of ``docs`` with the statistics, ``base_failed`` and ``kept``.

    A row fails the base rules with fewer than 50 words (so also if its text is null or
    empty), or if more than half of its words stand in repeated windows of three. Of the
    others, those are rejected whose perplexity lies outside the band of their language:
    ``fence`` times around the shortest range that holds half of the distinct texts of the
    language that pass the base rules. Junk apart from the others, as long as it is less than
    half of a language, is not in that range: if it is a third, the range spans three quarters
    of the others instead of half of them. Equal texts count once there, so that many copies
    of one text don't move the band; they get the same verdict. For the same reason a text
    that more than one in ``COPIED`` rows hold counts once in the model, or it would have
    learned that text by heart. A null language is a language
    of its own. Every row is judged by itself, also if ids or rows repeat. An empty table gives an empty table.
    Columns of ``docs`` with the names of new ones are replaced. The text is left out
    with ``keep_text=False``.
    """
    new = [*_STATS, "lower", "upper", "base_failed", "kept"]
    passed = Passed(docs, [c for c in docs.columns if c not in (text_column, *new)])
    lang = F.coalesce(docs[lang_column].cast("string"), F.lit(_NO_LANGUAGE)).alias("lang")
    text = docs[text_column]
    same = F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))
    rows = docs.select(passed.struct, lang, same.alias("same"), text.alias("text"))
    model = Model.fit(_copied_once(rows.select("same", "text")))
    scored = written(score(rows, model, keep_text), "quality")
    short = F.col("n_words") < MIN_WORDS
    repeats = 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    scored = scored.withColumn("base_failed", short | repeats)
    found = bands(scored, fence)
    inside = F.col("log_perplexity").between(F.col("lower"), F.col("upper"))
    result = spread_join(scored, written(found, "bands"), ["lang"])
    result = result.withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(True)))
    columns = {c: passed.get(c) for c in passed.columns}
    if keep_text:
        columns[text_column] = F.col("text").alias(text_column)
    return result.select(*(columns[c] for c in docs.columns if c in columns), *new)
