"""Histogram sort into shards of nearly equal bytes.

Rows are ordered by a key of three 63-bit numbers: a hash of the text, a hash of the id,
and the row's place in its scan. So equal texts are neighbours, and no two rows share a
key, which lets a splitter cut through a group of any size. Splitters are found by counting:
each round lays evenly spaced probes into the range that holds a wanted boundary, sums the
exact bytes between probes over all partitions, and goes on inside the interval where the
boundary falls. Only these sums, a few hundred numbers, reach the driver. When every
splitter meets the tolerance, the rows are exchanged once.

All of it is DataFrame functions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringledger.llm.rows import Passed
from ringledger.llm.storage import written

SHARDS = 8
#: Allowed distance of a splitter from its target, as a share of a shard's bytes.
TOLERANCE = 0.0005
PROBES = 64

_TOP = 1 << 63
_KEY = ["k0", "k1", "k2"]


@dataclass
class _Search:
    """Where one splitter must lie: keys that start with ``prefix``, then ``low`` to ``high``.

    ``below`` holds the bytes before ``low``. A settled splitter sends keys smaller than
    ``prefix + [low]`` (missing parts count as 0) to the shards before it.
    """

    target: float
    prefix: tuple[int, ...] = ()
    low: int = 0
    high: int = _TOP
    below: int = 0
    settled: bool = False

    @property
    def range(self) -> tuple:
        return self.prefix, self.low, self.high

    @property
    def splitter(self) -> tuple[int, int, int]:
        return (*self.prefix, self.low, 0, 0)[:3]


def text_size(text: Column) -> Column:
    """UTF-8 bytes plus one; a null text has none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def find_splitters(
    keys: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE
) -> list[tuple[int, int, int]]:
    """Ascending splitters for ``keys``, which has the columns k0, k1, k2 and ``size``."""
    total = keys.agg(F.sum("size")).first()[0] or 0
    allowed = tolerance * total / shards
    searches = [_Search(total * i / shards) for i in range(1, shards)]
    while not all(s.settled for s in searches):
        open_ranges = sorted({s.range for s in searches if not s.settled})
        sums = _sums(keys, open_ranges)
        for search in searches:
            if not search.settled:
                _refine(search, sums[search.range], allowed)
    return sorted(s.splitter for s in searches)


def _step(low: int, high: int) -> int:
    return max(1, -(-(high - low) // PROBES))


def _sums(keys: DataFrame, ranges: list[tuple]) -> dict[tuple, dict[int, tuple[int, int]]]:
    """Bytes and rows by range and interval between probes, from one pass over the keys."""
    places = []
    for number, (prefix, low, high) in enumerate(ranges):
        key = F.col(_KEY[len(prefix)])
        inside = (key >= low) & (key <= high - 1)
        for name, value in zip(_KEY, prefix):
            inside &= F.col(name) == value
        interval = F.expr(f"({_KEY[len(prefix)]} - {low}L) div {_step(low, high)}L")
        place = F.struct(F.lit(number).alias("range"), interval.cast("int").alias("interval"))
        places.append(F.when(inside, place))
    # Ranges of one level are equal or apart, but a range of a deeper level lies in others.
    found = keys.select("size", F.explode(F.array_compact(F.array(*places))).alias("place"))
    counted = found.groupBy("place.range", "place.interval").agg(
        F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")
    )
    sums: dict[tuple, dict[int, tuple[int, int]]] = {r: {} for r in ranges}
    for row in counted.collect():  # at most PROBES rows a range, and a range a splitter
        sums[ranges[row["range"]]][row["interval"]] = row["bytes"], row["rows"]
    return sums


def _refine(search: _Search, sums: dict[int, tuple[int, int]], allowed: float) -> None:
    step = _step(search.low, search.high)
    below, interval = search.below, 0
    for interval in range(PROBES):
        size, _ = sums.get(interval, (0, 0))
        if below + size > search.target or interval == PROBES - 1:
            break
        below += size
    size, rows = sums.get(interval, (0, 0))
    start = search.low + interval * step
    search.below, search.low, search.high = below, start, min(start + step, search.high)
    short, over = search.target - below, below + size - search.target
    if min(short, over) <= allowed or rows <= 1:
        search.settled = True
        if over < short and search.high < _TOP:
            search.low, search.below = search.high, below + size
    elif step == 1:
        search.prefix, search.low, search.high = (*search.prefix, start), 0, _TOP


def _before(splitter: tuple[int, int, int]) -> Column:
    a, b, c = splitter
    k0, k1, k2 = (F.col(k) for k in _KEY)
    return (k0 < a) | ((k0 == a) & ((k1 < b) | ((k1 == b) & (k2 < c))))


def shard_by_bytes(
    docs: DataFrame,
    shards: int = SHARDS,
    tolerance: float = TOLERANCE,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``docs`` with ``size``, ``shard`` (from 0) and ``slot`` (gapless from 0 in its shard).

    The bytes before each splitter are within ``tolerance`` of a shard's share of the
    target, or as near as a single row allows. Slots follow the key, so equal texts get
    neighbouring slots, and repeated rows count as rows of their own. Null ids and null
    texts are keys like any other. An empty table gives an empty table. Columns of
    ``docs`` that are named like new ones are replaced.
    """
    new = ["size", "shard", "slot"]
    passed = Passed(docs, [c for c in docs.columns if c not in new])

    def positive(column: Column) -> Column:
        return F.shiftrightunsigned(F.xxhash64(column), 1)

    # Written once: the place in the scan must be the same row in every pass.
    rows = written(
        docs.select(
            passed.struct,
            positive(docs[text_column]).alias("k0"),
            positive(docs[id_column]).alias("k1"),
            F.monotonically_increasing_id().alias("k2"),
            text_size(docs[text_column]).alias("size"),
        ),
        "keys",
    )
    splitters = find_splitters(rows.select(*_KEY, "size"), shards, tolerance)
    shard = F.lit(0)
    for splitter in splitters:
        shard = shard + F.when(_before(splitter), 0).otherwise(1)
    partitions = max(shards, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # The exchange. A row's place in its partition follows from the id that Spark gives out:
    # the partition above bit 33, the row below. The offsets are those of the written rows.
    placed = written(
        rows.withColumn("shard", shard)
        .repartitionByRange(partitions, *_KEY)
        .sortWithinPartitions(*_KEY)
        .withColumn("place", F.monotonically_increasing_id())
        .drop(*_KEY),
        "shards",
    )
    part = F.shiftright("place", 33).alias("part")
    counts = placed.groupBy("shard", part).agg(
        F.count(F.lit(1)).alias("n"), F.min("place").alias("first")
    )
    # A row for each partition and shard, so one task holds them whatever the corpus holds.
    offsets = counts.selectExpr(
        "shard",
        "part",
        "first - coalesce(sum(n) over (partition by shard order by part"
        " rows between unbounded preceding and 1 preceding), 0) as start",
    )
    joined = placed.withColumn("part", part).join(F.broadcast(offsets), ["shard", "part"])
    return joined.select(
        *passed.all(),
        "size",
        "shard",
        (F.col("place") - F.col("start")).alias("slot"),
    )
