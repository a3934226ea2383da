"""Words of whole texts as numbers, in batches of bounded size, for use inside tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WHITE = b" \t\n\x0b\x0c\r"
SLICE_BYTES = 4 << 20
VOCABULARY_WORDS = 1 << 20
VOCABULARY_BYTES = 32 << 20
#: For tasks that keep much else, or whose work on a new word is slight.
FEW_WORDS = 1 << 18


def slices(
    batches: Iterable[pa.RecordBatch], column: str, most: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each has at most ``most`` bytes of text, or a single row.

    What Arrow keeps of earlier batches goes back before the next one, and at the end: workers
    outlive their tasks, and share an executor's memory with its JVM.
    """
    spare = pa.default_memory_pool().release_unused
    for batch in batches:
        spare()
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(False)
        ends, start = np.cumsum(sizes, dtype=np.int64), 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(start, stop - start)
            start = stop
    spare()


def utf8(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8; null is empty."""
    return [text or b"" for text in column.cast(pa.binary()).to_pylist()]


class Vocabulary(dict):
    """Numbers words in the order they come; ``full`` says when to start a new one.

    Words are what stands between ASCII white space, as bytes.split() has it. Smaller ones
    take less memory, and are started anew more often.
    """

    def __init__(self, most: int = VOCABULARY_WORDS) -> None:
        self.words: list[bytes] = []
        self.most, self.size = most, 0

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.words)
        self.words.append(word)
        self.size += len(word)
        return number

    @property
    def full(self) -> bool:
        return len(self.words) > self.most or self.size > VOCABULARY_BYTES

    def frequent(self, counts: np.ndarray) -> np.ndarray:
        """Whether a word is among the quarter that ``counts`` has most of, more than once.

        Kept on when the others go, these save most of the work that a new start repeats.
        None is, if they alone would fill the vocabulary.
        """
        quarter = len(counts) // 4
        if not quarter:
            return np.zeros(len(counts), bool)
        often = counts > max(1, np.partition(counts, -quarter)[-quarter])
        size = sum(len(self.words[i]) for i in np.flatnonzero(often).tolist())
        return often if 2 * size <= VOCABULARY_BYTES else np.zeros(len(counts), bool)

    def only(self, chosen: np.ndarray) -> Vocabulary:
        """A new vocabulary of the chosen words, numbered in the same order."""
        new = Vocabulary(self.most)
        for i in np.flatnonzero(chosen).tolist():
            new[self.words[i]]
        return new

    def number(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The words of all texts as numbers, and where each text starts (and the end)."""
        parts, starts = [], np.zeros(len(texts) + 1, np.int64)
        for i, text in enumerate(texts):
            words = text.split()
            starts[i + 1] = starts[i] + len(words)
            parts.append(np.fromiter(map(self.__getitem__, words), np.int64, len(words)))
        return np.concatenate(parts or [np.zeros(0, np.int64)]), starts


def mix(values: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers (the finaliser of the public-domain splitmix64)."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def sums_between(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of ``values[starts[i]:starts[i + 1]]``, also where that is empty."""
    total = np.zeros(len(values) + 1, values.dtype if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[starts[1:]] - total[starts[:-1]]


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    seen, repeated = set(), 0
    for line in text.split(b"\n"):
        if line in seen:
            repeated += 1
        elif line.strip(WHITE):
            seen.add(line)
    return repeated


def repeated_words(ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Words in windows of three words that a text has more than once, the first included."""
    out = np.zeros(len(starts) - 1, np.int64)
    for i, (a, b) in enumerate(zip(starts[:-1], starts[1:])):
        if b - a < 4:
            continue
        own, bits = ids[a:b], 21
        windows = (own[:-2] << 2 * bits) | (own[1:-1] << bits) | own[2:]
        if own.max() >> bits:  # three numbers don't fit 63 bits: number the pairs first
            _, pairs = np.unique((own[:-1] << 31) | own[1:], return_inverse=True)
            windows = (pairs[:-1] << 31) | own[2:]
        order = np.argsort(windows, kind="stable")
        equal = windows[order[1:]] == windows[order[:-1]]
        if equal.any():
            repeated = np.zeros(b - a + 2, bool)
            again = np.r_[False, equal] | np.r_[equal, False]
            places = order[again]
            for shift in range(3):
                repeated[places + shift] = True
            out[i] = repeated.sum()
    return out
