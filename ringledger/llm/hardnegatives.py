"""Hard negatives by lists that the anchors of a cluster share.

Anchors are grouped around a few directions. For a block of rows and a direction the rows
are sorted once by an upper bound of their score: a row of length |x| at angle t to the
direction scores at most |u| |x| cos(max(0, t - w)) with any anchor u that lies within the
angle w of it. All anchors of the group walk that one list from the top, a stretch at a time,
and an anchor stops where the bound falls below the last place of its result: what is left
can't enter it. The angles decide how far the walks go, never what they find.

There are two walks: the first finds each anchor's positives, the second, for each positive,
the best rows of other labels in the window that the positive's score sets. Anchors are sent
to the tasks in batches of bounded size; rows stay where they are. Only the few best of each
block are shuffled, to be ranked.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringledger.llm.storage import shared_path, written

POSITIVES, NEGATIVES = 5, 3
#: The window of a negative's score, in hundredths of the positive's.
LOW, HIGH = 50, 95
SCALE = 256
#: Directions, and the anchors they are learned from; they bear on speed only.
DIRECTIONS, SAMPLE = 32, 4096
#: Bytes of anchor vectors in a batch, and rows of a block.
BATCH_BYTES, BLOCK_ROWS = 32 << 20, 1 << 15
#: Rows of a list that are scored at once, at first; stretches double.
STRETCH = 256
#: Added to angles and bounds, far above what floating point loses.
SLACK = 1e-6


# Vectors.


def matrix(lists: pa.Array) -> np.ndarray:
    """A row for each list, shorter ones filled up with zeros."""
    lengths = lists.value_lengths().to_numpy(False).astype(np.int64)
    wide = int(lengths.max(initial=0))
    out = np.zeros((len(lists), wide))
    inside = np.arange(wide) < lengths[:, None]
    out[inside] = lists.flatten().to_numpy(False)
    return out


def wider(x: np.ndarray, wide: int) -> np.ndarray:
    return np.pad(x, ((0, 0), (0, wide - x.shape[1])))


def products(u: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of the whole-numbered rows of ``u`` and ``x``."""
    most = np.abs(u).max(initial=0) * np.abs(x).max(initial=0) * max(u.shape[1], 1)
    if most < 2**24:
        return (u.astype(np.float32) @ x.T.astype(np.float32)).astype(np.int64)
    if most < 2**53:
        return (u @ x.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    return whole(u).dot(whole(x).T)  # Python's numbers; beyond a long they raise an error


def directions(sample: np.ndarray, number: int, rounds: int = 8) -> np.ndarray:
    """Unit vectors that the sample gathers around, by spherical k-means."""
    size = np.linalg.norm(sample, axis=1)
    unit = sample[size > 0] / size[size > 0][:, None]
    if not len(unit):
        return np.zeros((1, sample.shape[1]))
    centres, near = unit[:1], unit @ unit[0]
    while len(centres) < min(number, len(unit)) and near.min() < 1 - 1e-9:
        centres = np.r_[centres, unit[[near.argmin()]]]
        near = np.maximum(near, unit @ centres[-1])
    for _ in range(rounds):
        own = (unit @ centres.T).argmax(axis=1)
        sums = np.stack([unit[own == k].sum(axis=0) for k in range(len(centres))])
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(length > 0, sums / np.maximum(length, 1e-12), centres)
    return centres


def _angles(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Angles to a unit vector; a zero vector has angle 0, its length makes up for it."""
    length = np.linalg.norm(x, axis=1)
    cosine = np.divide(x @ centre, length, out=np.ones(len(x)), where=length > 0)
    return np.arccos(np.clip(cosine, -1, 1))


# Walks.


@dataclass
class Anchors:
    """Anchors of a batch, and what each looks for: its goals.

    A goal is a row of ``owner`` (the anchor), ``least`` and ``most`` (the scores allowed).
    """

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    centres: np.ndarray
    owner: np.ndarray
    least: np.ndarray
    most: np.ndarray
    #: Whether rows of the anchor's own label are sought, or those of others.
    same: bool
    wanted: int

    def groups(self) -> Iterator[tuple[int, float, list[tuple[int, np.ndarray]]]]:
        """Directions, the widest angle of their anchors, and these anchors by label."""
        length = np.linalg.norm(self.vectors, axis=1)
        own = (self.vectors @ self.centres.T).argmax(axis=1)
        for k in np.unique(own):
            members = np.flatnonzero(own == k)
            wide = _angles(self.vectors[members[length[members] > 0]], self.centres[k])
            parts = [(lab, members[self.labels[members] == lab]) for lab in np.unique(self.labels[members])]
            yield int(k), float(wide.max(initial=0)), parts


class Best:
    """The best rows of each goal so far: by score, then by smaller id, each id once."""

    def __init__(self, least: np.ndarray, wanted: int) -> None:
        self.bar, self.wanted = least.copy(), wanted
        none = np.zeros(0, np.int64)
        self.goal, self.id, self.score = none, none, none

    def add(self, goal: np.ndarray, id_: np.ndarray, score: np.ndarray) -> None:
        goal, id_ = np.r_[self.goal, goal], np.r_[self.id, id_]
        score = np.r_[self.score, score]
        order = np.lexsort((-score, id_, goal))
        goal, id_, score = goal[order], id_[order], score[order]
        first = np.r_[True, (goal[1:] != goal[:-1]) | (id_[1:] != id_[:-1])][: len(goal)]
        goal, id_, score = goal[first], id_[first], score[first]
        order = np.lexsort((id_, -score, goal))
        goal, id_, score = goal[order], id_[order], score[order]
        begin = np.flatnonzero(np.r_[True, goal[1:] != goal[:-1]][: len(goal)])
        sizes = np.diff(np.r_[begin, len(goal)])
        place = np.arange(len(goal)) - np.repeat(begin, sizes)
        keep = place < self.wanted
        self.goal, self.id, self.score = goal[keep], id_[keep], score[keep]
        full = place == self.wanted - 1
        self.bar[goal[full]] = np.maximum(self.bar[goal[full]], score[full])


def walk(
    anchors: Anchors, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, count: list | None = None
) -> Best:
    """The best rows of a block for every goal. ``count`` gets the number of scores taken."""
    wide = max(x.shape[1], anchors.vectors.shape[1])
    x, u = wider(x, wide), wider(anchors.vectors, wide)
    length, reach = np.linalg.norm(x, axis=1), np.linalg.norm(u, axis=1)
    best = Best(anchors.least, anchors.wanted)
    goals_of = np.argsort(anchors.owner, kind="stable")
    first = np.searchsorted(anchors.owner[goals_of], np.arange(len(anchors.ids) + 1))
    for k, angle, parts in anchors.groups():
        apart = np.maximum(0, _angles(x, wider(anchors.centres[[k]], wide)[0]) - angle - SLACK)
        bound = length * (np.cos(apart) + SLACK)
        shared = np.argsort(-bound, kind="stable")
        for label, members in parts:
            own = shared[(labels[shared] == label) == anchors.same]
            _walk_one(anchors, best, members, own, bound, ids, x, u, reach, goals_of, first, count)
    return best


def _walk_one(anchors, best, members, own, bound, ids, x, u, reach, goals_of, first, count) -> None:
    """One group of anchors down one list."""
    start, stretch = 0, STRETCH
    goals = np.concatenate([goals_of[first[m] : first[m + 1]] for m in members])
    while start < len(own) and len(goals):
        # Certified: nothing from here on reaches the last place of a goal that stops.
        goals = goals[bound[own[start]] * reach[anchors.owner[goals]] + SLACK >= best.bar[goals]]
        if not len(goals):
            break
        part = own[start : start + stretch]
        users, row = np.unique(anchors.owner[goals], return_inverse=True)
        scores = products(u[users], x[part])
        if count is not None:
            count.append(scores.size)
        at_once = max(1, (1 << 22) // len(part))
        for i in range(0, len(goals), at_once):
            some, seen = goals[i : i + at_once], scores[row[i : i + at_once]]
            fits = (seen >= best.bar[some][:, None]) & (seen <= anchors.most[some][:, None])
            fits &= ids[part] != anchors.ids[anchors.owner[some]][:, None]
            g, r = np.nonzero(fits)
            best.add(some[g], ids[part][r], seen[g, r].astype(np.int64))
        start, stretch = start + stretch, 2 * stretch


def _blocks(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        while batch.num_rows:
            room = rows - sum(b.num_rows for b in kept)
            kept.append(batch.slice(0, room))
            batch = batch.slice(room)
            if sum(b.num_rows for b in kept) == rows:
                yield pa.Table.from_batches(kept).combine_chunks().to_batches()[0]
                kept = []
    if kept:
        yield pa.Table.from_batches(kept).combine_chunks().to_batches()[0]


def _best_of_blocks(rows: DataFrame, anchors: Anchors, block_rows: int) -> DataFrame:
    """``goal, id, score`` of every block's best for the goals of a batch."""
    shared = rows.sparkSession.sparkContext.broadcast(anchors)

    def tasks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, block_rows):
            ids, labels = (block.column(c).to_numpy(False) for c in ("id", "label"))
            best = walk(shared.value, ids, labels, matrix(block.column("vector")))
            columns = [pa.array(c) for c in (best.goal, best.id, best.score)]
            yield pa.RecordBatch.from_arrays(columns, ["goal", "id", "score"])

    return rows.select("id", "label", "vector").mapInArrow(tasks, "goal long, id long, score long")


def _ranked(found: DataFrame, wanted: int) -> DataFrame:
    """The best ``wanted`` of all blocks for each goal, with their ``rank``."""
    once = found.repartition("goal").groupBy("goal", "id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("goal").orderBy(F.desc("score"), "id"))
    return once.withColumn("rank", rank).where(F.col("rank") <= wanted)


# The operator.


def whole_vectors(
    rows: DataFrame, id_column: str, vector_column: str, label_column: str, scale: int = SCALE
) -> DataFrame:
    """``id, label, vector`` of the rows that take part, components as ``floor(scale * x)``."""
    vector = rows[vector_column]
    # A number is finite if it is neither null nor NaN and differs from both infinities.
    finite = F.forall(
        vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")).cast("double"))
    )
    # Whole numbers as doubles: rounding down by a remainder, as floor() would give longs.
    def down(v: Column) -> Column:
        grown = v.cast("double") * float(scale)
        return F.when(F.abs(grown) >= 2.0**53, grown).otherwise(F.floor(grown).cast("double"))

    some = rows.where(rows[id_column].isNotNull() & rows[label_column].isNotNull() & vector.isNotNull())
    return some.where(finite).select(
        rows[id_column].cast("long").alias("id"),
        rows[label_column].cast("long").alias("label"),
        F.transform(vector, down).alias("vector"),
    )


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: int = SCALE,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    batch_bytes: int = BATCH_BYTES,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Hard negatives of each anchor and positive, best first.

    A score is the inner product of two vectors with components ``floor(scale * x)``, exact;
    of equal scores the smaller id comes first. Anchors are the rows where ``is_anchor``, a
    condition on the column ``id``, holds. An anchor's positives are the first
    ``positives`` other rows of its label. For each, the first ``negatives`` rows of other
    labels are returned whose score lies between ``low`` and ``high`` hundredths of the
    positive's, both included: ``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score``. Fewer are returned where there are fewer.

    Rows with a null id, label, vector or component, or one that isn't finite, take no
    part. Missing components of shorter vectors count as 0, also of an empty vector. Rows
    that share an id count once for an anchor, with their best score, and never for an
    anchor of that id; of anchors that share an id the one with the smallest label and
    vector counts. An empty table gives no rows. Only the three named columns are read. A
    score that doesn't fit a long raises an error.
    """
    spark = rows.sparkSession
    table = written(whole_vectors(rows, id_column, vector_column, label_column, scale), "vectors")
    chosen = table.where(is_anchor).groupBy("id").agg(F.min(F.struct("label", "vector")).alias("least"))
    anchors = written(chosen.select("id", "least.*"), "anchors")
    size = anchors.agg(F.count(F.lit(1)).alias("rows"), F.max(F.size("vector")).alias("wide")).first()
    path = shared_path(spark, "hard-negatives")
    kinds = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], kinds).write.parquet(path)
    batches = -(-size["rows"] * 8 * max(size["wide"] or 0, 1) // batch_bytes)
    centres = _centres(anchors, size["rows"]) if size["rows"] else None
    for batch in range(batches):
        own = anchors.where(F.pmod(F.xxhash64("id"), F.lit(batches)) == batch).toArrow().combine_chunks()
        if own.num_rows:
            found = _of_batch(table, own, centres, positives, negatives, low, high, block_rows)
            found.write.mode("append").parquet(path)
    return spark.read.schema(kinds).parquet(path)


def _centres(anchors: DataFrame, rows: int) -> np.ndarray:
    """Directions from a sample of the anchors, bounded by ``SAMPLE``."""
    share = int(min(1.0, SAMPLE / rows) * (1 << 32))
    some = anchors.where(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1 << 32)) < share)
    sample = some.orderBy("id").limit(2 * SAMPLE).select("vector").toArrow().combine_chunks()
    lists = sample.column("vector").combine_chunks()
    return directions(matrix(lists) if len(lists) else np.zeros((0, 1)), DIRECTIONS)


def _of_batch(
    table: DataFrame, own: pa.Table, centres: np.ndarray, positives: int, negatives: int,
    low: int, high: int, block_rows: int,
) -> DataFrame:
    """The result for the anchors of one batch."""
    spark = table.sparkSession
    ids, labels = own.column("id").to_numpy(), own.column("label").to_numpy()
    vectors = matrix(own.column("vector").combine_chunks())
    wide = max(vectors.shape[1], centres.shape[1])
    vectors, centres = wider(vectors, wide), wider(centres, wide)
    each, ends = np.arange(len(ids)), np.iinfo(np.int64)
    first = Anchors(
        ids, labels, vectors, centres, each, np.full(len(ids), ends.min), np.full(len(ids), ends.max),
        True, positives,
    )
    near = _ranked(_best_of_blocks(table, first, block_rows), positives)
    near = near.orderBy("goal", "rank").select("goal", "id", "score").toArrow()
    owner, score = near.column("goal").to_numpy(), near.column("score").to_numpy()
    # -(-a // b) rounds up. Python's numbers, since products may pass a long.
    least = np.array([-(-low * s // 100) for s in score.tolist()], np.int64)
    most = np.array([high * s // 100 for s in score.tolist()], np.int64)
    some = least <= most
    second = Anchors(
        ids, labels, vectors, centres, owner[some], least[some], most[some], False, negatives
    )
    goals = pa.table(
        {"goal": np.arange(int(some.sum())), "anchor_id": ids[owner[some]],
         "positive_id": near.column("id").to_numpy()[some], "positive_score": score[some]}
    )
    found = _ranked(_best_of_blocks(table, second, block_rows), negatives)
    # The goals are a table of bounded size, as long as a batch.
    return found.join(spark.createDataFrame(goals), "goal").select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
