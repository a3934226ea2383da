"""Find benchmark items in documents, also after edits, by CGK embedding and bit sampling.

An item of n words is found in a document where some run of words is within
``SHARE`` * n edits of it (words put in, left out or changed; A-Z in lower case). If the
edits are d, one of d + 1 parts of the item is still intact, so only windows that have the
first words of such a part in their place, give or take d words, can hold the item. Each
window of n words, and the item, is embedded by random walks: a walk copies the word it
stands on and a coin, tossed by step and word, tells whether it moves on. After an edit two
walks soon fall back in step, so few edits leave many of the 3 n places equal. Windows
that agree with the item in all places of one of many small samples are candidates, and
the exact edit distance decides.

The benchmark is the query set. It goes to the tasks in blocks of ``BLOCK`` items, and the
documents are read in place, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringledger.llm.rows import Passed
from ringledger.llm.words import FEW_WORDS, Vocabulary, mix, slices, utf8

#: Edits allowed, as a share of an item's words.
SHARE = 0.2
#: Shorter items are no evidence of anything and are left out.
MIN_WORDS = 8
BLOCK = 20_000

#: The fewest intact words that d edits leave in a row, for items of MIN_WORDS or more.
_SEED = 3
#: A pair at the allowed distance agrees in about two fifths of the places, so in a sample
#: of two with a chance of 0.16; 128 samples miss it with a chance below 1 in a billion.
WALKS, SAMPLES, SAMPLE = 8, 16, 2
_WINDOWS_AT_ONCE = 4096
_HITS_AT_ONCE = 1 << 20

_MATCH = "array<struct<item_id:long,start:long,length:long,edits:long>>"
_ARROW_MATCH = pa.list_(
    pa.struct([(name, pa.int64()) for name in ("item_id", "start", "length", "edits")])
)


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)


def _rolled(words: np.ndarray) -> np.ndarray:
    """Hashes of _SEED words in a row, by their first."""
    size = max(0, len(words) - _SEED + 1)
    out = np.zeros(size, np.uint64)
    for i in range(_SEED):
        out = mix(out ^ words[i : i + size])
    return out


# Embedding.


def embed(windows: np.ndarray, walk: int, places: int) -> np.ndarray:
    """The first places (a row each) of CGK embeddings of equally long word sequences."""
    count, n = windows.shape
    padded = np.concatenate([windows, np.zeros((count, 1), np.uint64)], axis=1).ravel()
    row = np.arange(count) * (n + 1)
    at, end = row.copy(), row + n
    # A word's coins for all steps are the bits of its hashes, 64 steps a hash.
    out = np.zeros((places, count), np.uint64)
    for step in range(places):
        if step % 64 == 0:
            salt = np.uint64(((walk << 32) + step + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
            coins = mix(padded ^ salt)
        out[step] = padded[at]
        at += ((coins[at] >> np.uint64(step % 64)) & np.uint64(1)).astype(np.int64)
        np.minimum(at, end, out=at)
    return out


def _samples(n: int, walk: int) -> np.ndarray:
    """Places of the samples of a walk over n words. Late places mostly hold padding."""
    random = np.random.default_rng([n, walk])
    return random.integers(0, 2 * n, (SAMPLES, SAMPLE))


def agree(windows: np.ndarray, items: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Which windows equal ``items[row]`` in all places of some sample."""
    found = np.zeros(len(windows), bool)
    n = windows.shape[1]
    for walk in range(WALKS):
        open_ = np.flatnonzero(~found)
        if not len(open_):
            break
        # Only sampled places are compared.
        places = _samples(n, walk)
        mine, theirs = embed(windows[open_], walk, 2 * n), embed(items, walk, 2 * n)
        hit = np.zeros(len(open_), bool)
        for sample in places:
            equal = np.ones(len(open_), bool)
            for place in sample:
                equal &= mine[place] == theirs[place][row[open_]]
            hit |= equal
        found[open_] = hit
    return found


def _spread(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each length, its index that often, and the numbers from 0."""
    owner = np.repeat(np.arange(len(lengths)), lengths)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def edit_distance(item: np.ndarray, words: np.ndarray) -> tuple[int, int]:
    """Fewest edits from ``item`` to any run of ``words``, and where such a run ends."""
    columns = np.arange(len(words) + 1)
    row = np.zeros(len(words) + 1, np.int64)
    for word in item:
        new = np.r_[row[0] + 1, np.minimum(row[1:] + 1, row[:-1] + (words != word))]
        row = np.minimum.accumulate(new - columns) + columns
    end = int(row.argmin())
    return int(row[end]), end


def _start(item: np.ndarray, words: np.ndarray) -> int:
    """Where a closest run that ends with ``words`` starts."""
    _, length = edit_distance_to_prefix(item[::-1], words[::-1])
    return len(words) - length


def edit_distance_to_prefix(item: np.ndarray, words: np.ndarray) -> tuple[int, int]:
    """Fewest edits from ``item`` to a run at the start of ``words``, and its length."""
    columns = np.arange(len(words) + 1)
    row = columns.copy()
    for word in item:
        new = np.r_[row[0] + 1, np.minimum(row[1:] + 1, row[:-1] + (words != word))]
        row = np.minimum.accumulate(new - columns) + columns
    length = int(row.argmin())
    return int(row[length]), length


# Search.


@dataclass
class _Item:
    number: int | None
    words: np.ndarray
    edits: int


class Index:
    """The parts of a block of items by the hash of their first words."""

    def __init__(self, rows: list[tuple[int | None, str | None]], share: float) -> None:
        self.items: list[_Item] = []
        seeds, item_of, offset = [], [], []
        for number, text in rows:
            words = _hashes((text or "").encode().lower().split())
            if len(words) < MIN_WORDS:
                continue
            edits = int(share * len(words))
            rolled = _rolled(words)
            for start in np.arange(edits + 1) * len(words) // (edits + 1):
                seeds.append(rolled[min(start, len(rolled) - 1)])
                item_of.append(len(self.items))
                offset.append(min(start, len(rolled) - 1))
            self.items.append(_Item(number, words, edits))
        order = np.argsort(np.array(seeds, np.uint64), kind="stable")
        self.seeds = np.array(seeds, np.uint64)[order]
        self.item_of = np.array(item_of, np.int64)[order]
        self.offset = np.array(offset, np.int64)[order]
        self.sizes = np.array([len(i.words) for i in self.items], np.int64)
        self.edits = np.array([i.edits for i in self.items], np.int64)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self.seeds >> np.uint64(44)] = True

    def search(self, words: np.ndarray) -> list[dict]:
        """The items in a document (hashes of its words): the closest run for each."""
        return self.search_all(words, np.array([0, len(words)]))[0]

    def search_all(self, words: np.ndarray, starts: np.ndarray) -> list[list[dict]]:
        """The items in each of several documents, laid end to end from ``starts``."""
        found: list[list[dict]] = [[] for _ in starts[1:]]
        doc, item, start = self._candidates(words, starts)
        pair = doc * len(self.items) + item
        for own in np.split(np.arange(len(pair)), np.flatnonzero(np.diff(pair)) + 1):
            if len(own):
                d = doc[own[0]]
                text = words[starts[d] : starts[d + 1]]
                best = self._best(self.items[item[own[0]]], start[own], text)
                if best:
                    found[d].append(best)
        return found

    def _candidates(self, words: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
        """Document, item and start of the windows that agree in a sample, in this order."""
        parts = []
        for doc, item, start in self._windows(words, starts):
            size = self.sizes[item]
            order = np.argsort(size, kind="stable")
            for own in np.split(order, np.flatnonzero(np.diff(size[order])) + 1):
                for at in range(0, len(own), _WINDOWS_AT_ONCE):
                    some = own[at : at + _WINDOWS_AT_ONCE]
                    places = (starts[doc[some]] + start[some])[:, None] + np.arange(size[own[0]])
                    inside = places < starts[doc[some] + 1][:, None]
                    windows = np.where(inside, words[np.minimum(places, len(words) - 1)], 0)
                    numbers, row = np.unique(item[some], return_inverse=True)
                    items = np.stack([self.items[i].words for i in numbers])
                    kept = some[agree(windows.astype(np.uint64), items, row)]
                    parts.append(np.stack([doc[kept], item[kept], start[kept]]))
        every = np.concatenate(parts, axis=1) if parts else np.zeros((3, 0), np.int64)
        return tuple(np.unique(every, axis=1))

    def _windows(self, words: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """Document, item and start of the windows to look at, some at a time."""
        rolled = _rolled(words)
        places = np.flatnonzero(self.maybe[rolled >> np.uint64(44)])
        low = np.searchsorted(self.seeds, rolled[places], "left")
        number = np.searchsorted(self.seeds, rolled[places], "right") - low
        doc = np.searchsorted(starts, places, "right") - 1
        real = (number > 0) & (places + _SEED <= starts[doc + 1])
        places, low, number, doc = places[real], low[real], number[real], doc[real]
        cost = np.cumsum(number * (2 * self.edits.max(initial=0) + 1))
        for own in np.split(np.arange(len(places)), np.flatnonzero(np.diff(cost // _HITS_AT_ONCE)) + 1):
            hit, nth = _spread(number[own])
            seed = low[own][hit] + nth
            item = self.item_of[seed]
            first = places[own][hit] - starts[doc[own]][hit] - self.offset[seed]
            edits = self.edits[item]
            hit_of, shift = _spread(2 * edits + 1)
            of, item = doc[own][hit][hit_of], item[hit_of]
            last = np.maximum(0, starts[of + 1] - starts[of] - self.sizes[item] + edits[hit_of])
            start = np.clip(first[hit_of] - edits[hit_of] + shift, 0, last)
            # One number for the three, so that repeats go with a plain sort.
            longest = int(start.max(initial=0)) + 1
            key = np.unique((of * len(self.items) + item) * longest + start)
            pair = key // longest
            yield pair // len(self.items), pair % len(self.items), key % longest

    def _best(self, item: _Item, kept: np.ndarray, words: np.ndarray) -> dict | None:
        n, edits, best = len(item.words), item.edits, None
        # Candidates next to each other are one stretch of text.
        for run in np.split(kept, np.flatnonzero(np.diff(kept) > n) + 1):
            begin = max(0, run[0] - edits)
            text = words[begin : run[-1] + n + edits]
            distance, end = edit_distance(item.words, text)
            if distance <= edits and (best is None or distance < best["edits"]):
                start = _start(item.words, text[:end])
                best = {
                    "item_id": item.number, "start": int(begin + start),
                    "length": int(end - start), "edits": distance,
                }
        return best


def _matched(rows: DataFrame, block: list[tuple[int | None, str | None]], share: float) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(Index(block, share))

    def tasks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, vocabulary, hashes = shared.value, Vocabulary(FEW_WORDS), np.zeros(0, np.uint64)
        for batch in slices(batches, "text"):
            if vocabulary.full:
                vocabulary, hashes = Vocabulary(FEW_WORDS), np.zeros(0, np.uint64)
            ids, starts = vocabulary.number([t.lower() for t in utf8(batch.column("text"))])
            hashes = np.r_[hashes, _hashes(vocabulary.words[len(hashes) :])]
            found = index.search_all(hashes[ids], starts)
            before = batch.column("matches").to_pylist()
            matches = pa.array([x + y for x, y in zip(before, found)], _ARROW_MATCH)
            columns = [batch.column("row"), batch.column("text"), matches]
            yield pa.RecordBatch.from_arrays(columns, ["row", "text", "matches"])

    return rows.mapInArrow(tasks, rows.schema)


def find_items(
    docs: DataFrame,
    benchmark: DataFrame,
    share: float = SHARE,
    text_column: str = "text",
    matches_column: str = "matches",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """``docs`` with the column ``matches``, which replaces one of that name.

    It lists the items found: their id, the first word and the number of words of
    the closest run, and its edits (the first such stretch, if several are equally near).
    A null or empty text has none. Items with a null text or fewer than ``MIN_WORDS``
    words are left out; an item with a null id is found under a null id, and repeated items
    are found each. Rows count by themselves, also where ids or rows repeat; an empty
    table, or an empty benchmark, is no special case.
    """
    passed = Passed(docs, [c for c in docs.columns if c not in (text_column, matches_column)])
    none = F.expr(f"cast(array() as {_MATCH})").alias("matches")
    rows = docs.select(passed.struct, docs[text_column].alias("text"), none)
    rows = rows.to(T.StructType([rows.schema["row"], rows.schema["text"]]).add("matches", _type()))
    items = benchmark.select(benchmark[item_column].cast("long"), benchmark[item_text_column])
    block: list[tuple[int | None, str | None]] = []
    for item in items.toLocalIterator():
        block.append(tuple(item))
        if len(block) == BLOCK:
            rows, block = _matched(rows, block, share), []
    if block:
        rows = _matched(rows, block, share)
    columns = {c: passed.get(c) for c in passed.columns} | {text_column: F.col("text")}
    kept = [columns[c].alias(c) for c in docs.columns if c in columns]
    return rows.select(*kept, F.col("matches").alias(matches_column))


def _type() -> T.DataType:
    fields = [T.StructField(f.name, T.LongType()) for f in _ARROW_MATCH.value_type]
    return T.ArrayType(T.StructType(fields))


def decontaminated(docs: DataFrame, benchmark: DataFrame, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no item was found, with all their columns."""
    found = "benchmark items found"  # no name of a column of docs
    clean = find_items(docs, benchmark, text_column=text_column, matches_column=found)
    return clean.where(F.size(F.col(f"`{found}`")) == 0).drop(found)
