"""Pack documents into fixed windows of tokens, in their order, by dynamic programming.

Each task takes its documents as they come, as one stream of tokens. Windows may end after
a document (free), after a sentence (``SENTENCE_PENALTY``) or, where neither comes for
``STRIDE``, anywhere on a grid (``WORD_PENALTY``). The cuts with the least padding
plus penalties follow from

    best[i] = window - place[i] + penalty[i] + min(best[j] + place[j])

over earlier cuts j within a window, a sliding minimum that a monotone queue gives in
constant time. A task works on about ``CHUNK`` windows at once and carries the last window
over, so only its last sequence may be short. There is no shuffle.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringledger.llm.tokens import WordTokenizer
from ringledger.llm.words import slices, utf8

WINDOW = 4096
END_ID = 2
SENTENCE_PENALTY = 8
WORD_PENALTY = 64
#: As parts of a window: how far apart cuts may be, and the grid where they would be farther.
STRIDE, GRID = 1 / 8, 1 / 64
CHUNK = 256

_SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long,"
    " sequence_id long, offset long"
)


def best_cuts(places: list[int], penalties: list[int], window: int = WINDOW) -> list[int]:
    """Which of ascending ``places`` end windows; the first is the start and the last an end.

    Neighbouring places must be at most ``window`` apart.
    """
    best, back = [0] * len(places), [0] * len(places)
    queue = deque([(places[0], places[0], 0)])  # best[j] + place[j], place[j], j
    for i in range(1, len(places)):
        place = places[i]
        while queue[0][1] < place - window:
            queue.popleft()
        cost, _, back[i] = queue[0]
        cost += window - place + penalties[i]
        best[i] = cost
        cost += place
        while queue and queue[-1][0] >= cost:
            queue.pop()
        queue.append((cost, place, i))
    cuts, i = [], len(places) - 1
    while i:
        cuts.append(places[i])
        i = back[i]
    return cuts[::-1]


class _Stream:
    """Documents in turn, cut into windows."""

    def __init__(self, window: int, keep_ids: bool) -> None:
        self.window, self.keep_ids = window, keep_ids
        # Parts of documents not yet in a window: doc_id, ids, tokens before, tokens of all.
        self.parts: list[tuple[int | None, np.ndarray, int, int]] = []
        self.places: list[int] = [0]
        self.penalties: list[int] = [0]
        self.size = self.sequences = 0

    def add(self, doc_id: int | None, ids: np.ndarray, ends: np.ndarray) -> None:
        self.parts.append((doc_id, ids, 0, len(ids)))
        inner = ends[(ends > 0) & (ends < len(ids) - 1)]
        marks = np.r_[0, inner, len(ids)]
        step = max(1, int(GRID * self.window))
        wide = np.flatnonzero(np.diff(marks) > max(1, STRIDE * self.window))
        grid = [np.arange(marks[k] + step, marks[k + 1], step) for k in wide]
        places = np.concatenate([inner, *grid])
        costs = np.repeat([SENTENCE_PENALTY, WORD_PENALTY], [len(inner), len(places) - len(inner)])
        order = np.argsort(places, kind="stable")
        self.places += (places[order] + self.size).tolist()
        self.penalties += costs[order].tolist()
        self.size += len(ids)
        self.places.append(self.size)
        self.penalties.append(0)

    def sequences_of(self, last: bool) -> list[dict]:
        """Pieces of the windows cut so far; but for the ``last`` call one window is kept."""
        cuts = best_cuts(self.places, self.penalties, self.window) if self.size else []
        if not last:
            cuts.pop()
        rows, begin, part = [], 0, 0
        for cut in cuts:
            left, offset = cut - begin, 0
            while left:
                doc_id, ids, start, total = self.parts[part]
                taken = ids[:left]
                row = {
                    "doc_id": doc_id, "start": start, "length": len(taken),
                    "ids_crc32": zlib.crc32(taken.astype("<u4").tobytes()), "doc_tokens": total,
                    "sequence_id": self.sequences, "offset": offset,
                }
                if self.keep_ids:
                    row["ids"] = taken.astype(np.int32)
                rows.append(row)
                left, offset = left - len(taken), offset + len(taken)
                if len(taken) == len(ids):
                    part += 1
                else:
                    self.parts[part] = doc_id, ids[len(taken) :], start + len(taken), total
            begin, self.sequences = cut, self.sequences + 1
        del self.parts[:part]
        keep = [(p - begin, c) for p, c in zip(self.places, self.penalties) if p >= begin]
        self.places, self.penalties = [p for p, _ in keep], [c for _, c in keep]
        self.size -= begin
        return rows


@cache
def _tokenizer(file: str) -> WordTokenizer:
    """One for each Python worker, which may run several tasks."""
    return WordTokenizer(file)


def pack(
    docs: DataFrame,
    tokenizer_file: str,
    window: int = WINDOW,
    keep_ids: bool = True,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """A row for each piece of a document: where it is in the document and in its sequence.

    ``start`` counts the document's ids before the piece, ``offset`` those before it in
    its sequence; ``ids`` holds the ids (left out with ``keep_ids=False``) and
    ``ids_crc32`` their checksum. A document's ids are those of its text and then
    ``END_ID``; a null or empty text has only the latter. Rows are packed in the order
    they are stored in, each as a document of its own also where ids or rows repeat, and a
    null id stays null. A document longer than a window goes over several sequences. An
    empty table gives no pieces. Only the two named columns are read.
    """

    def tasks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, stream = _tokenizer(tokenizer_file), _Stream(window, keep_ids)
        for batch in slices(batches, "text"):
            ids, bounds, ends = tokenizer.encode(utf8(batch.column("text")))
            for i, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                a, b = bounds[i], bounds[i + 1]
                inside = ends[np.searchsorted(ends, a, "right") : np.searchsorted(ends, b, "right")]
                stream.add(doc_id, np.r_[ids[a:b], np.uint32(END_ID)], inside - a)
                if stream.size > CHUNK * window:
                    yield from _batches(stream.sequences_of(last=False))
        tokenizer.clear()  # the worker lives on, and other tasks need the memory
        yield from _batches(stream.sequences_of(last=True))

    fields = [(name, pa.int64()) for name in _names()] + [("ids", pa.list_(pa.int32()))] * keep_ids
    schema = pa.schema(fields)

    def _batches(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(rows), 2000):
            yield pa.RecordBatch.from_pylist(rows[i : i + 2000], schema=schema)

    pieces = docs.select(
        docs[id_column].cast("long").alias("doc_id"), docs[text_column].alias("text")
    ).mapInArrow(tasks, _SCHEMA + ", ids array<int>" * keep_ids)
    # Sequences are numbered within a task; its partition makes the numbers apart.
    number = F.shiftleft(F.spark_partition_id().cast("long"), 40) + F.col("sequence_id")
    return pieces.withColumn("sequence_id", number)


def _names() -> list[str]:
    return [column.split()[0] for column in _SCHEMA.split(", ")]
