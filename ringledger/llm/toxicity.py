"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Every text becomes a short row of numbers: densities of the words of each lexicon, how near
they stand to words that address the reader, shares of capitals and of marks, rates of
words spelled to slip past a lexicon, and how much its words are those of toxic texts. For
the latter, words and their beginnings are counted in the learned texts of both labels, and
those kept that toxic texts have far more often than chance would have it: no list knows
the abuse of every language. Trees of bounded depth are boosted on the logistic
loss over binned features. Their log-odds are turned into probabilities by isotonic
regression, fitted on predictions that each part of the sample gets from trees grown on the
other parts. Features of all texts come from one pass in tasks; the trees are grown in numpy
on at most ``MAX_ROWS`` labelled rows, chosen by a hash of their id.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringledger.llm.rows import Passed
from ringledger.llm.splits import in_fold
from ringledger.llm.storage import written
from ringledger.llm.words import Vocabulary, slices, sums_between, utf8

MAX_ROWS = 20_000
FOLDS, HELD_OUT_FOLD = 4, 2
THRESHOLD = 0.3

BINS, DEPTH, ROUNDS, RATE = 32, 3, 80, 0.15
#: Added to the curvature of a leaf, and the least gain of a cut.
SMOOTHING, LEAST_GAIN = 2.0, 1e-3
#: Parts of the sample for the predictions that calibration is fitted on.
PARTS = 3
#: Weight of the uncalibrated probability in a score, so that texts within one step of the
#: calibration keep their order.
REST = 1e-3
#: How many beginnings of a word count as terms, in letters, besides the whole word.
BEGINNINGS = (3, 4, 5, 6)
#: Terms must be in so many toxic texts, and pass a likelihood ratio test at this value; the
#: best TERMS are kept.
LEAST_TEXTS, LEAST_RATIO, TERMS = 10, 30.0, 1 << 14
#: Words between a lexicon word and a word of address that still counts as near.
NEAR = 5

#: Common words of abuse, by kind, in English, German, French and Spanish.
LEXICONS: Mapping[str, tuple[str, ...]] = {
    "insults": (
        "airhead", "bonehead", "clown", "coward", "creep", "cretin", "dimwit", "dumb", "dumbass",
        "dummy", "dunce", "fool", "freak", "fraud", "halfwit", "hypocrite", "idiot", "idiotic",
        "idiots", "imbecile", "jerk", "liar", "loser", "losers", "lunatic", "moron", "moronic",
        "morons", "nitwit", "pig", "scumbag", "simpleton", "stupid", "twit", "weakling", "weirdo",
        "arschloch", "depp", "dummkopf", "dumm", "feigling", "idioten", "trottel", "versager",
        "abruti", "connard", "crétin", "débile", "idiote", "imbécile", "lâche", "menteur",
        "cobarde", "estúpido", "estúpida", "imbécil", "mentiroso", "payaso", "tonto",
    ),
    "contempt": (
        "disgrace", "disgusting", "filth", "filthy", "garbage", "inferior", "laughable",
        "parasite", "parasites", "pathetic", "repulsive", "revolting", "rubbish", "scum",
        "trash", "useless", "vermin", "vile", "worthless", "abschaum", "dreck", "ekelhaft",
        "erbärmlich", "wertlos", "dégoûtant", "minable", "ordure", "pathétique", "asqueroso",
        "basura", "escoria", "inútil", "patético",
    ),
    "profanity": (
        "ass", "asshole", "bastard", "bitch", "bullshit", "cunt", "damn", "dick", "fuck",
        "fucked", "fucker", "fucking", "motherfucker", "piss", "prick", "shit", "shitty", "slut",
        "whore", "fotze", "hurensohn", "scheiße", "wichser", "merde", "putain", "salope",
        "cabrón", "joder", "mierda", "puta",
    ),
    "threats": (
        "annihilate", "behead", "die", "exterminate", "hang", "kill", "lynch", "murder", "rape",
        "shoot", "slaughter", "stab", "strangle", "suffer", "töten", "umbringen", "verrecke",
        "crève", "tuer", "matar", "muere", "muérete",
    ),
}
#: Words that address the reader.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deinen deiner ihr euch euer tu te toi ton"
    " tes vous votre vos tú ti tus usted ustedes vosotros vuestro".split()
)
#: Signs that stand for letters.
_LOOKALIKES = str.maketrans("013457@$!|", "oieastasii")

_SHAPES = ["second", "upper_word", "elongated", "mixed", "masked", "single"]
_BYTES = {
    "exclamations": b"!", "questions": b"?", "symbols": b"#*$%&@^~|<>=+_",
    "digits": b"0123456789", "upper": bytes(range(65, 91)),
}


def feature_names(lexicons: Mapping[str, tuple[str, ...]] = LEXICONS) -> list[str]:
    return [
        "log_words", *lexicons, "any", "log_hits", "distinct_hits", "densest", "near_second",
        "closeness", *_SHAPES, "spelled_out", *_BYTES, "repeated_marks", "learned", "learned_weight",
    ]


# Terms.


def _terms_of(raw: bytes) -> list[int]:
    """Hashes of the beginnings of a word and of the whole, in lower case without its marks."""
    bare = _EDGES.sub("", raw.decode("utf-8", "replace")).lower()
    parts = [bare[:n] for n in BEGINNINGS if n <= len(bare)]
    return [xxhash.xxh64_intdigest(x) for x in (*parts, f"{bare} ")] if bare else []


@dataclass
class Terms:
    """Sorted hashes of terms, and how much oftener toxic texts have each, in logs."""

    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def of(self, words: list[bytes]) -> np.ndarray:
        """The weight of each word: that of its weightiest term, or 0."""
        out = np.zeros(len(words))
        if not len(self.keys):
            return out
        terms = [_terms_of(word) for word in words]
        hashes = np.fromiter(chain.from_iterable(terms), np.uint64)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        found = np.where(self.keys[at] == hashes, self.weights[at], 0.0)
        np.maximum.at(out, np.repeat(np.arange(len(words)), list(map(len, terms))), found)
        return out


def learned_terms(rows: DataFrame) -> Terms:
    """The terms of toxic texts, from ``text`` and ``label`` (0 or 1) of ``rows``."""

    def tasks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, terms = Vocabulary(), []
        for batch in slices(batches, "text"):
            if vocabulary.full:
                vocabulary, terms = Vocabulary(), []
            ids, starts = vocabulary.number(utf8(batch.column("text")))
            terms += [np.array(_terms_of(word), np.uint64) for word in vocabulary.words[len(terms) :]]
            label = batch.column("label").to_numpy(False)
            found = [
                np.unique(np.concatenate([terms[i] for i in np.unique(ids[a:b]).tolist()]))
                if b > a else np.zeros(0, np.uint64)
                for a, b in zip(starts[:-1], starts[1:])
            ]
            toxic = np.repeat(label, list(map(len, found)))
            keys, at = np.unique(np.concatenate(found), return_inverse=True)
            columns = [keys.view(np.int64)]
            columns += [np.bincount(at[toxic == y], minlength=len(keys)) for y in (1, 0)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["term", "a", "b"])

    texts = rows.agg(F.sum("label").alias("n1"), F.sum(1 - F.col("label")).alias("n0")).first()
    if not texts["n1"] or not texts["n0"]:
        return Terms()
    counts = (
        rows.select("text", F.col("label").cast("int").alias("label"))
        .mapInArrow(tasks, "term long, a long, b long")
        .groupBy("term")
        .agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
        .where(F.col("a") >= LEAST_TEXTS)
    )
    share = texts["n1"] / (texts["n1"] + texts["n0"])
    a, b, both = F.col("a"), F.col("b"), F.col("a") + F.col("b")
    ratio = 2 * (a * F.log(a / (both * share)) + F.when(b > 0, b * F.log(b / (both * (1 - share)))).otherwise(0))
    weight = F.log((a + 0.5) / (texts["n1"] + 1) * (texts["n0"] + 1) / (b + 0.5))
    chosen = counts.select("term", weight.alias("weight"), ratio.alias("ratio"))
    chosen = chosen.where((F.col("weight") > 0) & (F.col("ratio") >= LEAST_RATIO))
    best = chosen.orderBy(F.desc("ratio"), "term").limit(TERMS).toPandas()
    keys = best["term"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return Terms(keys[order], best["weight"].to_numpy(np.float64)[order])


# Features.


class Features:
    """Numbers of whole texts. What a word is, is found once for each distinct word."""

    def __init__(
        self, lexicons: Mapping[str, tuple[str, ...]] = LEXICONS, terms: Terms | None = None
    ) -> None:
        self.terms = terms or Terms()
        self.names, self.kinds = feature_names(lexicons), list(lexicons)
        self.lexicon = {word: i for i, kind in enumerate(lexicons) for word in lexicons[kind]}
        self.classes = np.zeros((256, len(_BYTES)))
        for i, members in enumerate(_BYTES.values()):
            self.classes[list(members), i] = 1
        self._clear()

    def _clear(self) -> None:
        self.vocabulary = Vocabulary()
        self.kind = np.zeros(0, np.int8)  # of the lexicon, or -1
        self.term = np.zeros(0, np.int32)  # which word of the lexicons, or -1
        self.shapes = np.zeros((0, len(_SHAPES)), bool)
        self.weight = np.zeros(0)  # of the learned terms, or 0

    def _learn(self, words: list[bytes]) -> None:
        kind, term = np.full(len(words), -1, np.int8), np.full(len(words), -1, np.int32)
        shapes = np.zeros((len(words), len(_SHAPES)), bool)
        terms = {word: i for i, word in enumerate(self.lexicon)}
        for i, raw in enumerate(words):
            text = raw.decode("utf-8", "replace")
            bare = _EDGES.sub("", text)
            low = bare.lower()
            found = low if low in self.lexicon else None
            if not found and len(text) > 2 and (_LONG.search(low) or not _PLAIN.fullmatch(text)):
                found = next((x for x in _unmasked(text) if x in self.lexicon), None)
                shapes[i, 4] = found is not None
            if found:
                kind[i], term[i] = self.lexicon[found], terms[found]
            shapes[i, 0] = low in SECOND_PERSON
            shapes[i, 1] = len(bare) > 1 and bare.isupper()
            shapes[i, 2] = bool(_LONG.search(low))
            shapes[i, 3] = bool(_MIXED.search(bare))
            shapes[i, 5] = len(bare) == 1 and bare.isalpha()
        self.kind, self.term = np.r_[self.kind, kind], np.r_[self.term, term]
        self.shapes = np.r_[self.shapes, shapes]
        self.weight = np.r_[self.weight, self.terms.of(words)]

    def of(self, texts: list[bytes]) -> np.ndarray:
        """A row for each text; a text without words has zeros but for its marks."""
        if self.vocabulary.full:
            self._clear()
        ids, starts = self.vocabulary.number(texts)
        self._learn(self.vocabulary.words[len(self.kind) :])
        words = np.diff(starts)
        some = np.maximum(words, 1)
        kind, shapes = self.kind[ids], self.shapes[ids]
        hit = kind >= 0
        hits = sums_between(hit, starts)
        out = {"log_words": np.log1p(words), "any": hits / some, "log_hits": np.log1p(hits)}
        for i, name in enumerate(self.kinds):
            out[name] = sums_between(kind == i, starts) / some
        for i, name in enumerate(_SHAPES):
            out[name] = sums_between(shapes[:, i], starts) / some
        places, text = np.flatnonzero(hit), np.repeat(np.arange(len(texts)), words)
        pairs = np.unique(text[places] * len(self.lexicon) + self.term[ids[places]])
        out["distinct_hits"] = np.bincount(pairs // len(self.lexicon), minlength=len(texts))
        out["densest"] = _densest(places, text, len(texts))
        gap = _gaps(places, np.flatnonzero(shapes[:, 0]), text)
        out["near_second"] = np.bincount(text[places], gap <= NEAR, len(texts)) / some
        out["closeness"] = np.bincount(text[places], 1 / (1 + gap), len(texts)) / np.maximum(hits, 1)
        single = shapes[:, 5]
        run = single.copy()  # four single letters in turn
        for shift in (1, 2, 3):
            run[:-shift] &= single[shift:] & (text[:-shift] == text[shift:])
            run[len(run) - shift :] = False
        out["spelled_out"] = sums_between(run, starts) / some
        marks = np.array([np.bincount(np.frombuffer(t, np.uint8), minlength=256) for t in texts])
        sizes = np.maximum(marks.sum(axis=1), 1)
        for name, values in zip(_BYTES, (marks @ self.classes / sizes[:, None]).T):
            out[name] = values
        out["repeated_marks"] = np.array([t.count(b"!!") + t.count(b"??") for t in texts]) / some
        weight = self.weight[ids]
        out["learned"] = sums_between(weight > 0, starts) / some
        # In steps of 2**-20 the sums are exact, so a text's doesn't depend on others.
        out["learned_weight"] = sums_between(np.rint(weight * 2**20).astype(np.int64), starts) / some / 2**20
        return np.stack([out[name] for name in self.names], axis=1).astype(np.float32)


_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_LONG = re.compile(r"([^\W\d_])\1\1")
_MIXED = re.compile(r"[^\W\d_][^\w'’-]+[^\W\d_]|[^\W\d_]\d+[^\W\d_]")
_RUN = re.compile(r"(.)\1+")
_PLAIN = re.compile(r"[\"'(]*[^\W\d_]*[.,;:!?\"')]*")
_RULE = re.compile(r"([^\w\s])\1\1+")


def _unmasked(word: str) -> Iterator[str]:
    """What a word may stand for: signs read as letters or left out, repeats drawn together."""
    low = _RULE.sub("", word.lower())
    for plain in (_EDGES.sub("", low).translate(_LOOKALIKES), low.translate(_LOOKALIKES), low):
        letters = "".join(x for x in plain if x.isalpha())
        yield letters
        yield _RUN.sub(r"\1\1", letters)
        yield _RUN.sub(r"\1", letters)


def _densest(places: np.ndarray, text: np.ndarray, texts: int, window: int = 50) -> np.ndarray:
    """The most lexicon words that begin within ``window`` words of one of them."""
    until = np.searchsorted(places, places + window)
    ends = np.searchsorted(text[places], text[places], "right")
    out = np.zeros(texts)
    np.maximum.at(out, text[places], np.minimum(until, ends) - np.arange(len(places)))
    return out


def _gaps(places: np.ndarray, others: np.ndarray, text: np.ndarray) -> np.ndarray:
    """How many words from each place to the nearest of ``others`` in its text, or infinity."""
    gap = np.full(len(places), np.inf)
    if len(others):
        after = np.searchsorted(others, places)
        for at in (np.clip(after, 0, len(others) - 1), np.clip(after - 1, 0, len(others) - 1)):
            same = text[others[at]] == text[places]
            gap = np.where(same, np.minimum(gap, np.abs(others[at] - places)), gap)
    return gap


def with_features(
    docs: DataFrame, lexicons: Mapping[str, tuple[str, ...]] = LEXICONS, terms: Terms | None = None
) -> DataFrame:
    """``row`` and ``features`` from ``row`` and ``text``."""

    def tasks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(lexicons, terms)
        for batch in slices(batches, "text"):
            values = features.of(utf8(batch.column("text")))
            offsets = pa.array(np.arange(len(values) + 1) * values.shape[1], pa.int32())
            lists = pa.ListArray.from_arrays(offsets, values.ravel())
            yield pa.RecordBatch.from_arrays([batch.column("row"), lists], ["row", "features"])

    schema = T.StructType([docs.schema["row"]]).add("features", T.ArrayType(T.FloatType()))
    return docs.mapInArrow(tasks, schema)


# Trees.


@dataclass
class Boosted:
    """Trees in full binary layout: node i has the children 2 i + 1 and 2 i + 2."""

    edges: list[np.ndarray]
    intercept: float = 0.0
    features: list[np.ndarray] = field(default_factory=list)
    cuts: list[np.ndarray] = field(default_factory=list)
    leaves: list[np.ndarray] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, v) for e, v in zip(self.edges, x.T)], axis=1)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        total, bins = np.full(len(x), self.intercept), self.bins(x) if len(x) else None
        for tree in zip(self.features, self.cuts, self.leaves) if len(x) else ():
            total += _walk(bins, *tree)
        return total


def _walk(bins: np.ndarray, features: np.ndarray, cuts: np.ndarray, leaves: np.ndarray) -> np.ndarray:
    node, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
    for _ in range(DEPTH):
        node = 2 * node + 1 + (bins[rows, features[node]] >= cuts[node])
    return leaves[node - len(features)]


def grow(x: np.ndarray, y: np.ndarray) -> Boosted:
    """Boosted trees for labels 0 or 1; without rows of both the log-odds are constant."""
    edges = [np.unique(np.quantile(v, np.arange(1, BINS) / BINS)) if len(v) else v for v in x.T]
    rate = (y.sum() + 1) / (len(y) + 2)
    model = Boosted(edges, float(np.log(rate / (1 - rate))))
    if len(np.unique(y)) < 2:
        return model
    bins, odds = model.bins(x), np.full(len(y), model.intercept)
    width = x.shape[1] * BINS
    cells = bins + np.arange(x.shape[1]) * BINS
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-odds))
        g, h = y - p, p * (1 - p)
        inner = 2**DEPTH - 1
        features, cuts = np.zeros(inner, np.int64), np.full(inner, BINS)
        node = np.zeros(len(y), np.int64)
        for depth in range(DEPTH):
            first, many = 2**depth - 1, 2**depth
            at = ((node - first)[:, None] * width + cells).ravel()
            shape = (many, x.shape[1], BINS)
            sums_g = np.bincount(at, np.repeat(g, x.shape[1]), many * width).reshape(shape)
            sums_h = np.bincount(at, np.repeat(h, x.shape[1]), many * width).reshape(shape)
            for i in range(many):
                features[first + i], cuts[first + i] = _cut(sums_g[i], sums_h[i])
            node = 2 * node + 1 + (bins[np.arange(len(y)), features[node]] >= cuts[node])
        leaf = node - inner
        up = np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + SMOOTHING)
        odds += RATE * up[leaf]
        model.features.append(features)
        model.cuts.append(cuts)
        model.leaves.append(RATE * up)
    return model


def _cut(g: np.ndarray, h: np.ndarray) -> tuple[int, int]:
    """The feature and the first bin to the right of the best cut; ``BINS`` cuts nothing."""
    left_g, left_h = g.cumsum(axis=1)[:, :-1], h.cumsum(axis=1)[:, :-1]
    all_g, all_h = g[0].sum(), h[0].sum()
    gain = left_g**2 / (left_h + SMOOTHING) + (all_g - left_g) ** 2 / (all_h - left_h + SMOOTHING)
    gain -= all_g**2 / (all_h + SMOOTHING)
    feature, at = np.unravel_index(gain.argmax(), gain.shape)
    return (int(feature), int(at) + 1) if gain[feature, at] > LEAST_GAIN else (0, BINS)


# Calibration.


@dataclass
class Calibration:
    """A rising function of log-odds, linear between the means of its steps."""

    odds: np.ndarray
    chance: np.ndarray

    def of(self, odds: np.ndarray) -> np.ndarray:
        plain = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        if not len(self.odds):
            return plain
        return (1 - REST) * np.interp(odds, self.odds, self.chance) + REST * plain


def isotonic(odds: np.ndarray, y: np.ndarray) -> Calibration:
    """The rising step function nearest to ``y``, by pooling neighbours that fall.

    Each step is drawn towards the overall rate by one row, so no chance is 0 or 1.
    """
    values, index = np.unique(odds, return_inverse=True)
    steps: list[list[float]] = []  # rows, labels, log-odds times rows
    each = np.bincount(index), np.bincount(index, y)
    for odd, n, positive in zip(values.tolist(), each[0].tolist(), each[1].tolist()):
        steps.append([n, positive, odd * n])
        while len(steps) > 1 and steps[-2][1] * steps[-1][0] >= steps[-1][1] * steps[-2][0]:
            last = steps.pop()
            steps[-1] = [a + b for a, b in zip(steps[-1], last)]
    rate = float(y.mean()) if len(y) else 0.0
    chance = np.array([(p + rate) / (n + 1) for n, p, _ in steps])
    return Calibration(np.array([o / n for n, _, o in steps]), np.maximum.accumulate(chance))


@dataclass
class Model:
    trees: Boosted
    calibration: Calibration

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.calibration.of(self.trees.log_odds(x))


def fit(x: np.ndarray, y: np.ndarray, part: np.ndarray) -> Model:
    """Trees on all rows, calibrated on what rows of each part get from the other parts."""
    odds = np.zeros(len(y))
    for k in np.unique(part):
        own = part == k
        odds[own] = grow(x[~own], y[~own]).log_odds(x[own])
    return Model(grow(x, y), isotonic(odds, y))


# The operator.


def labelled_sample(rows: DataFrame, key: Column, max_rows: int) -> DataFrame:
    """About ``max_rows`` of ``rows`` by a hash of ``key``, never more; all, if they are fewer."""
    many = rows.count()
    share = min(1.0, max_rows / max(many, 1))
    # The cut comes first, so that the sort sees little more than it returns.
    chosen = rows.where(F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 32)) < int(share * (1 << 32)))
    return chosen.orderBy(F.xxhash64(key), *rows.columns).limit(max_rows)


def classify(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    max_rows: int = MAX_ROWS,
    threshold: float = THRESHOLD,
    lexicons: Mapping[str, tuple[str, ...]] = LEXICONS,
) -> DataFrame:
    """``docs`` without the text, plus ``held_out``, ``score`` and ``predicted``.

    ``score`` is the chance that a text is toxic, ``predicted`` is 1 from ``threshold`` on.
    Learns from labels 0 and 1 of documents that are not held out, terms and trees each from
    ``max_rows`` of them; other labels and null ids are skipped, and a document with several
    labels counts with each. Null and empty
    texts get the score that such features have, long texts count whole. Without labels
    every score is one half, and an empty table gives an empty table. Rows count by
    themselves, also where ids or rows repeat; equal texts score alike. Columns of ``docs``
    named like new ones are replaced.
    """
    new = ["held_out", "score", "predicted"]
    passed = Passed(docs, [c for c in docs.columns if c not in (text_column, *new)])
    rows = docs.select(passed.struct, docs[text_column].alias("text"))
    key = passed.get(id_column)
    held_out = in_fold(key, FOLDS, HELD_OUT_FOLD)
    known = labels.select(labels[id_column].alias("id"), labels[label_column].alias("label"))
    known = known.where("label in (0, 1)")
    read = known.where(~in_fold(F.col("id"), FOLDS, HELD_OUT_FOLD) & F.col("id").isNotNull())
    read = F.broadcast(written(labelled_sample(read, F.col("id"), max_rows), "labels"))  # max_rows at most
    terms = learned_terms(rows.select(key.alias("id"), "text").join(read, "id").select("text", "label"))
    table = written(with_features(rows, lexicons, terms), "features")
    learned = (
        table.where(~held_out)
        .select(key.alias("id"), "features")
        .join(known, "id")
        .select("id", "label", "features", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(PARTS)).alias("part"))
    )
    sample = labelled_sample(learned, F.col("id"), max_rows).toPandas()
    x = np.array(sample["features"].tolist(), np.float32).reshape(-1, len(feature_names(lexicons)))
    model = fit(x, sample["label"].to_numpy(np.float64), sample["part"].to_numpy(np.int64))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(features: pd.Series) -> pd.Series:
        values = np.array(features.tolist(), np.float32).reshape(-1, len(shared.value.trees.edges))
        return pd.Series(shared.value.score(values))

    scored = table.select("row", held_out.alias("held_out"), score("features").alias("score"))
    predicted = F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted")
    return scored.select(*passed.all(), "held_out", "score", predicted)
