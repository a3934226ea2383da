"""Near-duplicate texts by DartMinHash signatures of weighted word shingles.

A text is a weighted set: its shingles of five words, each as often as it occurs. Every
shingle owns a region of the plane, its weight wide and unbounded in height, at which
hashed darts land, one per unit of area on average. A text sees the darts in its regions up
to a height that gives it about k ln k + 2 k of them, each dart belongs to one of k
coordinates, and the lowest dart of each coordinate is the signature (texts that miss a
coordinate look higher). Two texts agree in a coordinate with the probability of their
weighted Jaccard similarity, and the work is linear in the shingles plus k ln k.

Equal texts are one node. Signatures are cut into bands; texts that share a band are
candidates. All members of a band's bucket are first compared to its smallest member only,
and the similar ones are joined to components. What is left are buckets with several
components: texts around a shared passage or a much edited original, most of them not
similar enough. Their texts are compared to the member of the bucket with the fewest
shingles of its own, which links most of what there is to link. All other pairs are found by
a prefix filter, which loses none: shingles are put in one order, rare ones first, and a
pair that is similar enough must share one among the first of each, so early that what
follows can still add up to the similarity. Comparing means the exact similarity of the
texts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringledger.llm.components import components
from ringledger.llm.rows import Passed
from ringledger.llm.storage import written
from ringledger.llm.words import FEW_WORDS, Vocabulary, mix, slices, utf8

SHINGLE = 5
SIMILARITY = 0.8
#: A pair at similarity 0.8 shares a band but for a chance of 3 in a million.
BANDS, ROWS = 42, 6
COORDINATES = BANDS * ROWS
#: Cells that shingles are counted in, to put rare ones first. Any order gives all pairs.
CELLS = 1 << 20

_DARTS = COORDINATES * np.log(COORDINATES) + 2 * COORDINATES
_TEXTS_AT_ONCE = 500


# Weighted sets.


class Shingles:
    """Shingles of texts as 64-bit hashes with their counts."""

    def __init__(self) -> None:
        self._clear()

    def _clear(self) -> None:
        self.vocabulary, self.hashes = Vocabulary(FEW_WORDS), np.zeros(0, np.uint64)

    def of(self, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        """A shingle is five words in turn; a shorter text with words is one shingle."""
        if self.vocabulary.full:
            self._clear()
        ids, starts = self.vocabulary.number(texts)
        new = self.vocabulary.words[len(self.hashes) :]
        more = np.array([xxhash.xxh64_intdigest(word) for word in new], np.uint64)
        self.hashes = np.r_[self.hashes, more]
        words, sets = self.hashes[ids], []
        for a, b in zip(starts[:-1], starts[1:]):
            size = min(SHINGLE, b - a)
            shingles = np.zeros(b - a - size + 1 if b > a else 0, np.uint64)
            for i in range(size):
                shingles = mix(shingles ^ words[a + i : a + i + len(shingles)])
            sets.append(np.unique(shingles, return_counts=True))
        return sets


def similarity(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two shingle sets; 0 if both are empty."""
    _, i, j = np.intersect1d(x[0], y[0], assume_unique=True, return_indices=True)
    both = np.minimum(x[1][i], y[1][j]).sum()
    every = x[1].sum() + y[1].sum() - both
    return float(both / every) if every else 0.0


# Signatures.

#: Heights are cut into cells: up to 1/8, three that double, and then one for each unit.
_LOW = np.array([0, 0.125, 0.25, 0.5])
_SIZE = np.array([0.125, 0.125, 0.25, 0.5])


def _poisson_ladder(mean: float) -> np.ndarray:
    """Chances that a Poisson number is at most 0, 1, 2 and so on."""
    terms = [np.exp(-mean)]
    for n in range(1, 16):
        terms.append(terms[-1] * mean / n)
    return np.cumsum(terms)


def _unit(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(11)).astype(np.float64) * 2.0**-53


def _spread(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each length, its index that often, and the numbers from 0."""
    owner = np.repeat(np.arange(len(lengths)), lengths)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], k: int = COORDINATES) -> np.ndarray:
    """A row of ``k`` dart names for each weighted set (hashes and positive weights)."""
    out = np.zeros((len(sets), k), np.uint64)
    open_ = np.array([i for i, (_, weights) in enumerate(sets) if len(weights)], np.int64)
    heights = np.array([(k * np.log(k) + 2 * k) / sets[i][1].sum() for i in open_])
    while len(open_):
        names, found = _lowest_darts([sets[i] for i in open_], heights, k)
        out[open_[found]] = names[found]
        open_, heights = open_[~found], 2 * heights[~found]
    return out


def _lowest_darts(sets, heights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    owner = np.repeat(np.arange(len(sets)), [len(hashes) for hashes, _ in sets])
    elements = np.concatenate([hashes for hashes, _ in sets])
    weights = np.concatenate([weights for _, weights in sets]).astype(np.float64)
    # Cells: a unit of weight wide, and as high as the ladder of heights says.
    at, column = _spread(np.ceil(weights).astype(np.int64))
    top = heights[owner[at]]
    cells = np.where(top > 1, 4 + np.ceil(top - 1), 1 + (top > 0.125) + (top > 0.25) + (top > 0.5))
    base = mix(elements[at] ^ mix(column.astype(np.uint64) + np.uint64(1)))
    of, cell = _spread(cells.astype(np.int64))
    keys = mix(base[of] + cell.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    low = np.where(cell < 4, _LOW[np.minimum(cell, 3)], cell - 3.0)
    size = np.where(cell < 4, _SIZE[np.minimum(cell, 3)], 1.0)
    chance = _unit(keys)
    number = np.zeros(len(keys), np.int64)
    for mean in (0.125, 0.25, 0.5, 1.0):
        own = size == mean
        number[own] = np.searchsorted(_poisson_ladder(mean), chance[own], "right")
    # Darts: where in its cell each lands, which coordinate it belongs to, and its name.
    cell_of, dart = _spread(number)
    names = mix(mix(keys[cell_of]) + dart.astype(np.uint64))
    height = low[cell_of] + size[cell_of] * _unit(names)
    names = mix(names)
    source = at[of[cell_of]]
    text = owner[source]
    inside = height <= heights[text]
    inside &= column[of[cell_of]] + _unit(mix(names)) < weights[source]
    names, height, text = names[inside], height[inside], text[inside]
    place = text * k + (names % np.uint64(k)).astype(np.int64)
    lowest = np.full(len(sets) * k, np.inf)
    np.minimum.at(lowest, place, height)
    first = height == lowest[place]
    out = np.zeros(len(sets) * k, np.uint64)
    out[place[first]] = names[first]
    return out.reshape(-1, k), np.isfinite(lowest).reshape(-1, k).all(axis=1)


def bands(signature: np.ndarray, number: int = BANDS) -> np.ndarray:
    """A hash for each band of each signature."""
    rows = signature.reshape(len(signature), number, -1)
    out = np.broadcast_to(np.arange(number, dtype=np.uint64), rows.shape[:2])
    for i in range(rows.shape[2]):
        out = mix(out ^ rows[:, :, i])
    return out.view(np.int64)


def _with_bands(rows: DataFrame) -> DataFrame:
    def tasks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        for batch in slices(batches, "text", 1 << 20):
            sets = shingles.of(utf8(batch.column("text")))
            for start in range(0, len(sets), _TEXTS_AT_ONCE):
                part = batch.slice(start, _TEXTS_AT_ONCE)
                some = sets[start : start + _TEXTS_AT_ONCE]
                keys = bands(signatures(some))
                sizes = np.array([BANDS if len(s[0]) else 0 for s in some])
                full = keys[sizes > 0].ravel()
                lists = pa.ListArray.from_arrays(
                    pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), pa.array(full)
                )
                columns = [part.column("id"), part.column("a"), part.column("b"), lists]
                yield pa.RecordBatch.from_arrays(columns, ["id", "a", "b", "bands"])

    return rows.mapInArrow(tasks, "id long, a long, b long, bands array<long>")


# Candidates.


def _verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs ``a, b`` of nodes whose texts are at least that similar."""

    def tasks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, known = Shingles(), {}
        for batch in slices(slices(batches, "text_a", 1 << 20), "text_b", 1 << 20):
            nodes = [batch.column(c).to_pylist() for c in ("a", "b")]
            for side, column in zip(nodes, ("text_a", "text_b")):
                new = {n: i for i, n in enumerate(side) if n not in known}
                found = utf8(batch.column(column).take(pa.array(list(new.values()), pa.int64())))
                known.update(zip(new, shingles.of(found)))
            alike = [similarity(known[a], known[b]) >= least for a, b in zip(*nodes)]
            yield batch.select(["a", "b"]).filter(pa.array(alike, pa.bool_()))
            if len(known) > 500:
                known = {}

    first = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    second = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(first, "a").join(second, "b").mapInArrow(tasks, "a long, b long")


def _first_pairs(members: DataFrame) -> DataFrame:
    """Every member of a bucket with the bucket's smallest."""
    hubs = members.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("other"))
    return _with_hubs(members, hubs.where("hub < other").select("key", "hub"))


def _with_hubs(members: DataFrame, hubs: DataFrame) -> DataFrame:
    """Every member with the hub of its bucket. Hubs are written first: so the join has a
    shuffle to itself, and adaptive execution may split a bucket that holds many texts."""
    pairs = members.join(written(hubs, "hubs"), "key").where("node <> hub")
    ordered = pairs.select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b"))
    return ordered.distinct()


def _mixed(members: DataFrame) -> DataFrame:
    """The members of buckets with several components."""
    ends = members.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high")
    )
    several = written(ends.where("low < high").select("key"), "buckets")
    return members.join(several, "key", "left_semi")


# The prefix filter.


def _cells(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(20)) % np.uint64(CELLS)


def _shingle_counts(texts: DataFrame) -> np.ndarray:
    """In how many texts the shingles of each cell are; of one size, whatever the texts."""

    def tasks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, counts = Shingles(), np.zeros(CELLS, np.int64)
        for batch in slices(batches, "text", 1 << 20):
            sets = [_cells(hashes) for hashes, _ in shingles.of(utf8(batch.column("text")))]
            counts += np.bincount(np.concatenate(sets).astype(np.int64), minlength=CELLS)
        cells = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(counts[cells])], ["cell", "n"])

    found = texts.select("text").mapInArrow(tasks, "cell long, n long")
    table = found.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(CELLS, np.int64)
    out[table["cell"].to_numpy()] = table["n"].to_numpy()
    return out


def prefix(
    hashes: np.ndarray, weights: np.ndarray, counts: np.ndarray, least: float
) -> tuple[np.ndarray, np.ndarray, int]:
    """The first shingles of a set in the common order, rarest first, and the weight before.

    Also says how many of them are enough where the other set is at least as heavy. A set
    that shares less than the needed weight after all of its first shingles is not similar:
    a pair needs ``least`` of the heavier one's weight in common, and ``2 least / (1 +
    least)`` of the lighter one's.
    """
    order = np.lexsort((hashes, counts[_cells(hashes).astype(np.int64)]))
    weights = weights[order]
    before = np.cumsum(weights) - weights
    rest = weights.sum() - before
    long, short = (int((rest >= share * rest[0] - 1e-9).sum()) for share in (least, 2 * least / (1 + least)))
    return hashes[order[:long]], before[:long], short


def _prefixes(texts: DataFrame, counts: np.ndarray, least: float) -> DataFrame:
    """``shingle, node, total, rest, short, own`` of the first shingles of every text.

    ``rest`` is the weight from the shingle on; ``short`` marks the shingles that are looked
    up from texts at least as heavy. ``own`` is the text's share of shingles found nowhere
    else, or little, and the same in all rows of a node; its first row has all its weight
    as ``rest``.
    """
    shared = texts.sparkSession.sparkContext.broadcast(counts)

    def tasks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        for batch in slices(batches, "text", 1 << 20):
            nodes = batch.column("node").to_pylist()
            columns: list[list] = [[] for _ in range(6)]
            for node, (hashes, weights) in zip(nodes, shingles.of(utf8(batch.column("text")))):
                if not len(hashes):
                    continue
                first, before, short = prefix(hashes, weights, shared.value, least)
                total, many = int(weights.sum()), len(first)
                alone = weights[shared.value[_cells(hashes).astype(np.int64)] <= 1].sum() / total
                parts = [first.view(np.int64), np.full(many, node), np.full(many, total),
                         total - before, np.arange(many) < short, np.full(many, float(alone))]
                for column, part in zip(columns, parts):
                    column.append(part)
            if columns[0]:
                arrays = [pa.array(np.concatenate(column)) for column in columns]
                yield pa.RecordBatch.from_arrays(
                    arrays, ["shingle", "node", "total", "rest", "short", "own"]
                )

    kinds = "shingle long, node long, total long, rest long, short boolean, own double"
    return texts.select("node", "text").mapInArrow(tasks, kinds)


def _filtered_pairs(prefixes: DataFrame, parts: DataFrame, least: float) -> DataFrame:
    """Pairs of different components that may reach the similarity ``least``."""
    known = prefixes.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    known = written(known, "prefixes")
    heavy, light = (
        known.select("shingle", *(F.col(c).alias(f"{side}_{c}") for c in ("node", "component", "total", "rest", "short")))
        for side in ("h", "l")
    )
    light = light.where("l_short")
    # The weight in common that makes two sets similar, less what rounding may lose.
    needed = least / (1 + least) * (F.col("h_total") + F.col("l_total")) - 1e-6
    may = (
        (F.col("h_component") != F.col("l_component"))
        & (F.col("l_total") <= F.col("h_total"))
        & (F.least("h_rest", "l_rest") >= needed)
    )
    pairs = heavy.join(light, (heavy["shingle"] == light["shingle"]) & may)
    a, b = F.least("h_node", "l_node").alias("a"), F.greatest("h_node", "l_node").alias("b")
    return pairs.select(a, b).distinct()


# The operator.


def fingerprint(text: Column) -> tuple[Column, Column]:
    return F.xxhash64(text), F.xxhash64(F.lit(1), text)


def near_duplicates(
    docs: DataFrame,
    least: float = SIMILARITY,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``id, a, b, class_id, class_text`` of every row: its class of near-duplicates.

    Two texts are linked if they are equal or the weighted Jaccard similarity of their
    shingles is ``least`` or more, and a class is all that links connect. ``class_id`` is
    the smallest id in it; ``a`` and ``b`` are the hashes of the text and ``class_text``
    is true for the one text of each class that holds that id. A null text counts as an
    empty one; texts without words are linked only if they are equal. A null id is larger
    than others (a class of null ids has a null class id). Repeated rows are rows of their
    own, and an empty table gives no rows. Only the two named columns are read.
    """
    text = F.coalesce(docs[text_column], F.lit(""))
    a, b = fingerprint(text)
    rows = docs.select(
        docs[id_column].cast("long").alias("id"), a.alias("a"), b.alias("b"), text.alias("text")
    )
    every = written(_with_bands(rows), "bands")
    # The numbers of nodes are written with them, so they hold for all that follows.
    nodes = written(
        every.groupBy("a", "b")
        .agg(F.min("id").alias("id"), F.first("bands").alias("bands"))
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    pairs = written(_first_pairs(nodes.select("node", F.explode("bands").alias("key"))), "pairs")
    links = written(_verified(pairs, _texts(rows, nodes, pairs), least), "links")
    parts = written(components(links), "components")
    labelled = nodes.select("node", "bands").join(parts, "node", "left").select(
        "node", "bands", F.coalesce("component", "node").alias("component")
    )
    members = labelled.select("node", "component", F.explode("bands").alias("key"))
    mixed = written(_mixed(members), "mixed")
    texts = _texts(rows, nodes, mixed.select(F.col("node").alias("a"), F.col("node").alias("b")))
    prefixes = written(_prefixes(texts, _shingle_counts(texts), least), "prefixes")
    own = prefixes.where("rest = total").select("node", "own")
    ranked = mixed.join(own, "node").groupBy("key").agg(F.min(F.struct("own", "node")).alias("first"))
    second = _with_hubs(mixed, ranked.select("key", F.col("first.node").alias("hub")))
    second = written(second.join(pairs, ["a", "b"], "left_anti"), "pairs")
    links = written(links.union(_verified(second, texts, least)), "links")
    parts = written(components(links), "components")

    seen = pairs.union(second)
    third = _filtered_pairs(prefixes, parts, least).join(seen, ["a", "b"], "left_anti")
    links = links.union(_verified(written(third, "pairs"), texts, least))
    parts = written(components(links), "components")

    classed = nodes.select("node", "a", "b", "id").join(parts, "node", "left").select(
        "a", "b", "id", "node", F.coalesce("component", "node").alias("component")
    )
    order = F.struct(F.col("id").isNull().alias("none"), "id", "node")
    heads = classed.groupBy("component").agg(F.min(order).alias("head"))
    named = classed.join(heads, "component").select(
        "a",
        "b",
        F.col("head.id").alias("class_id"),
        (F.col("head.node") == F.col("node")).alias("class_text"),
    )
    return every.select("id", "a", "b").join(named, ["a", "b"])


def _texts(rows: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """``node, text`` of the nodes in ``pairs``: the row with the node's smallest id.

    The id is part of the key, so copies of one text spread over the tasks.
    """
    wanted = pairs.select("a").union(pairs.select("b")).distinct().withColumnRenamed("a", "node")
    wanted = nodes.select("node", "a", "b", _key("id")).join(wanted, "node")
    found = rows.select("a", "b", _key("id"), "text").join(wanted, ["a", "b", "id"])
    return written(found.dropDuplicates(["a", "b", "id"]).select("node", "text"), "texts")


def _key(name: str) -> Column:
    """An id that joins, whether null or not."""
    return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)


def deduplicated(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row of ``docs`` for each class of near-duplicates, with all its columns.

    It is a row with the class's smallest id and the text that has it. Of rows equal in id
    and text any one stays. See ``near_duplicates`` for nulls and empty texts.
    """
    found = near_duplicates(docs, id_column=id_column, text_column=text_column)
    same_id = F.col("id").eqNullSafe(F.col("class_id"))
    heads = found.where(F.col("class_text") & same_id).select(_key("id"), "a", "b").distinct()
    a, b = fingerprint(F.coalesce(docs[text_column], F.lit("")))
    passed = Passed(docs, docs.columns)
    rows = docs.select(passed.struct, _key_of(docs[id_column]).alias("id"), a.alias("a"), b.alias("b"))
    kept = rows.join(heads, ["id", "a", "b"], "left_semi").dropDuplicates(["id", "a", "b"])
    return kept.select(*passed.all())


def _key_of(column: Column) -> Column:
    return F.coalesce(column.cast("long").cast("string"), F.lit(""))
