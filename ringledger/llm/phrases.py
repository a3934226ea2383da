"""Phrase collocation mining by direct-address tiles of ranked ids.

The corpus is read once: tasks write their tokens as numbers into a chunk's own list of
distinct words, language by language, with a mark between pieces. All further passes read
these numbers.

Phrases grow by a word a pass. In each pass a chunk ranks by frequency the phrases that are
frequent in the corpus (words at first, then pairs, then triples: the recursion) and the
words that may follow them; a phrase of the next length is a pair of ranks. The plane of
pairs is cut into square tiles. Tiles with many entries are counted in place, one dense
``bincount`` each; the entries of all others are sorted together and counted as
coordinates.

Nearly all phrases of a chunk are rare in the corpus. So the counts are added up by key, the
phrase's hash: chunks give keys in order and packed, a few bytes for each phrase. A frequent
phrase is then spelled out by one of the chunks that hold it, its owner, and joined to its sum.

Which phrases are frequent, and which of them a chunk owns, reaches the tasks as bit fields of
fixed size. They lose no frequent phrase. They let some rare ones pass, or a second chunk's
copy, which costs rows and changes no result: the sums decide. A word is known by a 64-bit
hash, a phrase by one of these and its language.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringledger.llm.storage import shared_path, written
from ringledger.llm.words import Vocabulary, mix, slices, utf8

LEAST, LONGEST, TOP = 30, 4, 2000
#: A candidate goes if a longer one around it has this share of its count, in hundredths.
COVERED = 80
SCALE = 2_000_000
UNKNOWN = "und"

#: Bytes of text in a chunk, over all languages.
CHUNK_BYTES = 8 << 20
TILE_BITS = 8
#: Entries from which a tile is counted densely: a sixteenth of its cells.
DENSE = 1 << (2 * TILE_BITS - 4)
#: The bit field: its size, and bits set for a phrase.
FIELD_BITS, FIELD_HASHES = 26, 3
#: Places of the corpus for each group of keys, which bounds what a group's task holds.
GROUP_PLACES = 2 << 20
#: Groups that a language's candidates are dealt to before the last ranking.
SALTS = 32

_LOWER = bytes(range(97, 123))
_PREPARED = bytes.maketrans(bytes(range(65, 91)) + b".,;:!?\n\x0b\x0c\r", _LOWER + b"A" * 10)


# Chunks.


class _Chunk:
    """Texts of one language as numbers of distinct words, -1 between pieces."""

    def __init__(self) -> None:
        self.vocabulary = Vocabulary()
        self.mark = self.vocabulary[b"A"]
        self.parts: list[np.ndarray] = []

    def add(self, text: bytes) -> None:
        # No word holds an A any more, so an A of its own can stand for a separator.
        words = text.translate(_PREPARED).replace(b"A", b" A ").split()
        words.append(b"A")
        self.parts.append(np.fromiter(map(self.vocabulary.__getitem__, words), np.int32, len(words)))

    def batch(self, lang: str) -> pa.RecordBatch:
        ids = np.concatenate(self.parts) - 1
        words = self.vocabulary.words[1:]
        counts = np.bincount(ids[ids >= 0], minlength=len(words))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
        columns = [
            pa.array([word.decode("utf-8", "replace") for word in words], pa.string()),
            pa.array(hashes.view(np.int64)), pa.array(counts, pa.int64()),
        ]
        lists = [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in columns]
        # Only tasks look into the ids, so Spark gets them packed.
        packed = pa.compress(ids.astype(np.int32).tobytes(), "zstd", asbytes=True)
        return pa.RecordBatch.from_arrays(
            [pa.array([lang]), *lists, pa.array([len(ids)], pa.int64()), pa.array([packed], pa.binary())],
            ["lang", "words", "hashes", "counts", "size", "ids"],
        )


def unpacked(size: int, ids: bytes) -> np.ndarray:
    return np.frombuffer(pa.decompress(ids, 4 * size, "zstd"), np.int32)


def chunks(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``lang, words, hashes, counts, size, ids`` of chunks, from ``lang`` and ``text``.

    A text is never cut, so a chunk holds a whole text however long it is.
    """

    def tasks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[str, _Chunk] = {}
        size = 0
        for batch in slices(batches, "text"):
            for lang, text in zip(batch.column("lang").to_pylist(), utf8(batch.column("text"))):
                if lang not in open_:
                    open_[lang] = _Chunk()
                open_[lang].add(text)
                size += len(text)
            if size >= chunk_bytes:
                yield from (chunk.batch(lang) for lang, chunk in open_.items())
                open_, size = {}, 0
        yield from (chunk.batch(lang) for lang, chunk in open_.items())

    return docs.mapInArrow(
        tasks,
        "lang string, words array<string>, hashes array<long>, counts array<long>, size long, ids binary",
    )


def _written_chunks(docs: DataFrame, chunk_bytes: int) -> DataFrame:
    """Chunks as a table. Their rows are large, so the writer looks at its size after each."""
    found = chunks(docs, chunk_bytes)
    path = shared_path(docs.sparkSession, "chunks")
    checks = {f"parquet.{x}.size.row.check.min": 1 for x in ("block", "page")}
    options = checks | {"parquet.block.size": 16 << 20, "compression": "zstd"}
    found.write.options(**options).parquet(path)
    return docs.sparkSession.read.schema(found.schema).parquet(path)


# The bit field.


def _start(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(lang, seed=1))


def _longer(keys: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Keys of phrases one word longer."""
    return mix(keys ^ hashes)


def _keys(starts: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Keys of phrases, rows of the hashes of their words, in languages with these starts."""
    keys = starts
    for column in words.T:
        keys = _longer(keys, column)
    return keys


def _owned(keys: np.ndarray, chunks: np.ndarray | np.uint64) -> np.ndarray:
    """Keys that say that a chunk owns a phrase."""
    return mix(keys ^ chunks)


def _places(keys: np.ndarray) -> np.ndarray:
    """Bits of each key in the field, a row for each."""
    turns = np.arange(1, FIELD_HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(keys[:, None] + turns) >> np.uint64(64 - FIELD_BITS)


def _bits(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit words of the field that the keys set bits in, and these bits."""
    places = np.unique(_places(keys))
    words, first = np.unique(places >> np.uint64(6), return_index=True)
    ones = np.uint64(1) << (places & np.uint64(63))
    return words, np.bitwise_or.reduceat(ones, first) if len(words) else ones


def _inside(field: np.ndarray, keys: np.ndarray) -> np.ndarray:
    places = _places(keys)
    set_ = field[(places >> np.uint64(6)).astype(np.int64)] >> (places & np.uint64(63))
    return (set_ & np.uint64(1)).all(axis=1)


def _field(frequent: DataFrame) -> np.ndarray:
    """The bit field of a table ``lang, phrase``; its size is the same for any table."""

    def tasks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            phrases = batch.column("phrase")
            words = pc.list_flatten(phrases).to_numpy(False).view(np.uint64)
            words = words.reshape(batch.num_rows, -1) if batch.num_rows else words.reshape(0, 1)
            starts = {x: _start(x) for x in batch.column("lang").unique().to_pylist()}
            first = np.array([starts[x] for x in batch.column("lang").to_pylist()], np.uint64)
            yield _bit_rows(_keys(first, words))

    return _gathered(frequent.select("lang", "phrase").mapInArrow(tasks, "place long, bits long"))


def _bit_rows(keys: np.ndarray) -> pa.RecordBatch:
    places, ones = _bits(keys)
    arrays = [pa.array(places.view(np.int64)), pa.array(ones.view(np.int64))]
    return pa.RecordBatch.from_arrays(arrays, ["place", "bits"])


def _gathered(found: DataFrame) -> np.ndarray:
    """The bit field of a table ``place, bits``, which has no more rows than the field words."""
    table = found.groupBy("place").agg(F.bit_or("bits").alias("bits")).toArrow()
    field = np.zeros(1 << (FIELD_BITS - 6), np.uint64)
    field[table["place"].to_numpy()] = table["bits"].to_numpy().view(np.uint64)
    return field


# Tiles.


def by_rank(ids: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of kept things replaced by their rank, the commonest first, others by -1.

    ``keep`` says for each thing whether it is kept. Also gives the things by rank.
    """
    counts = np.bincount(ids[ids >= 0], minlength=len(keep))
    order = np.argsort(-counts, kind="stable")
    order = order[keep[order]]
    rank = np.full(len(keep) + 1, -1, np.int64)  # the last entry is for the id -1
    rank[order] = np.arange(len(order))
    return rank[ids], order


def count_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of ranks with their counts, counted tile by tile."""
    side = 1 << TILE_BITS
    wide = (int(b.max()) >> TILE_BITS) + 1 if len(b) else 1
    tile = (a >> TILE_BITS) * wide + (b >> TILE_BITS)
    cell = ((a & (side - 1)) << TILE_BITS) | (b & (side - 1))
    tiles, entries = np.unique(tile, return_counts=True)
    full = tiles[entries >= DENSE]
    in_full = np.isin(tile, full)
    # Sparse tiles: all their entries sorted, as coordinates.
    codes, counts = np.unique((tile[~in_full] << 2 * TILE_BITS) | cell[~in_full], return_counts=True)
    found, numbers = [codes], [counts]
    # Dense tiles: every cell has its own counter.
    order = np.argsort(tile[in_full], kind="stable")
    cells = cell[in_full][order]
    bounds = np.r_[0, np.cumsum(entries[entries >= DENSE])]
    for number, start, stop in zip(full, bounds[:-1], bounds[1:]):
        counters = np.bincount(cells[start:stop], minlength=side * side)
        used = np.flatnonzero(counters)
        found.append((number << 2 * TILE_BITS) | used)
        numbers.append(counters[used])
    code = np.concatenate(found)
    tile, cell = code >> 2 * TILE_BITS, code & (side * side - 1)
    first = ((tile // wide) << TILE_BITS) | (cell >> TILE_BITS)
    second = ((tile % wide) << TILE_BITS) | (cell & (side - 1))
    return first, second, np.concatenate(numbers)


def count_phrases(
    lang: str,
    hashes: np.ndarray,
    ids: np.ndarray,
    fields: list[np.ndarray],
    last: np.ndarray | None = None,
    chunk: np.uint64 | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """Phrases of a chunk one word longer than there are fields: rows of hashes, and counts.

    Only phrases are counted whose shorter parts are all in their field, and which are
    in ``last`` themselves: as this ``chunk``'s own, if it is given.
    """
    phrases, hashes, keys, a, b, counts = _grown(lang, hashes, ids, fields)
    if last is not None:
        chosen = _inside(last, keys if chunk is None else _owned(keys, chunk))
        a, b, counts = a[chosen], b[chosen], counts[chosen]
    # In order of their beginnings, which then repeat and compress well.
    order = np.argsort(a * len(hashes) + b)
    return np.c_[phrases[a[order]], hashes[b[order]]], counts[order]


def count_keys(
    lang: str, hashes: np.ndarray, ids: np.ndarray, fields: list[np.ndarray]
) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the phrases that ``count_phrases`` counts, in order, and counts."""
    _, _, keys, _, _, counts = _grown(lang, hashes, ids, fields)
    order = np.argsort(keys)
    return keys[order], counts[order].astype(np.uint64)


def _frequent_sums(
    keys: np.ndarray, counts: np.ndarray, least: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys whose counts add up to ``least``, the sums, and for each one of its entries.

    The entry is any of those of the key, by its value, so that many keys spread over all.
    """
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sums = np.add.reduceat(counts[order], first)
    entries = np.diff(np.r_[first, len(keys)])
    often = sums >= least
    found = keys[first[often]]
    entry = first[often] + (found % entries[often].astype(np.uint64)).astype(np.int64)
    return found, sums[often], order[entry]


def _grown(lang: str, hashes: np.ndarray, ids: np.ndarray, fields: list[np.ndarray]):
    """Hashes of beginnings and of last words, and of each phrase its key, both parts and count."""
    hashes = hashes.view(np.uint64)
    keys = _longer(np.full(len(hashes), _start(lang)), hashes)
    word, order = by_rank(ids, _inside(fields[0], keys))
    hashes, keys = hashes[order], keys[order]
    phrase, phrases = word, hashes[:, None]
    for length in range(2, len(fields) + 2):
        last = word[length - 1 :]
        begin = phrase[: len(last)]
        after = phrase[1 : len(last) + 1]  # what stands a word later is frequent as well
        after = after if len(after) == len(last) else np.r_[after, -1]
        at = np.flatnonzero((begin >= 0) & (last >= 0) & (after >= 0))
        a, b, counts = count_pairs(begin[at], last[at])
        if length == len(fields) + 1:
            return phrases, hashes, _longer(keys[a], hashes[b]), a, b, counts
        longer = np.c_[phrases[a], hashes[b]]
        keys = _longer(keys[a], hashes[b])
        # Number the phrases at their places, and rank what may be frequent again.
        code, width = a * len(hashes) + b, len(hashes)
        sort = np.argsort(code)
        number = np.full(len(begin), -1, np.int64)
        number[at] = sort[np.searchsorted(code[sort], begin[at] * width + last[at])]
        phrase, order = by_rank(number, _inside(fields[length - 1], keys))
        phrases, keys = longer[order], keys[order]
    raise ValueError("a field is needed")


def _packed(values: np.ndarray, counts: np.ndarray) -> bytes:
    """Rising values and their counts, byte by byte in planes, most of which are alike."""
    both = np.concatenate([np.diff(values, prepend=np.uint64(0)), counts]).astype("<u8")
    return pa.compress(both.view(np.uint8).reshape(-1, 8).T.tobytes(), "zstd", asbytes=True)


def _unpacked(size: int, packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(pa.decompress(packed, 16 * size, "zstd"), np.uint8).reshape(8, -1)
    both = np.ascontiguousarray(planes.T).view("<u8").ravel()
    return np.cumsum(both[:size], dtype=np.uint64), both[size:]


def _sums(table: DataFrame, fields: list[np.ndarray], least: int, group_bits: int) -> DataFrame:
    """``key, f, owner`` of the frequent phrases one word longer than there are fields.

    Keys are summed in groups by their leading ``group_bits``. The owner is a chunk that holds
    the phrase.
    """
    shared = table.sparkSession.sparkContext.broadcast(fields)
    below = np.uint64(64 - group_bits)

    def tasks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, lang, hashes, ids in _of_chunks(batch):
                keys, counts = count_keys(lang, hashes, ids, shared.value)
                groups, first = np.unique(keys >> below, return_index=True)
                bounds = [*first.tolist(), len(keys)]
                packed = [
                    _packed(keys[i:j] - (group << below), counts[i:j])
                    for group, i, j in zip(groups, bounds, bounds[1:])
                ]
                arrays = [groups.astype(np.int64), np.full(len(groups), chunk).view(np.int64), np.diff(bounds)]
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, arrays), pa.array(packed, pa.binary())], ["part", "chunk", "size", "packed"]
                )

    def merged(key: tuple, rows: pa.Table) -> pa.Table:
        sizes = rows["size"].to_numpy()
        parts = zip(sizes.tolist(), rows["packed"].to_pylist())
        keys, counts = (np.concatenate(x) for x in zip(*(_unpacked(*part) for part in parts)))
        keys, sums, entry = _frequent_sums(keys, counts, least)
        keys = keys + (np.uint64(key[0].as_py()) << below)
        owner = rows["chunk"].to_numpy()[np.searchsorted(np.cumsum(sizes), entry, "right")]
        arrays = [pa.array(x) for x in (keys.view(np.int64), sums.astype(np.int64), owner)]
        return pa.Table.from_arrays(arrays, ["key", "f", "owner"])

    parts = _chunk_ids(table).mapInArrow(tasks, "part long, chunk long, size long, packed binary")
    return written(parts.groupBy("part").applyInArrow(merged, "key long, f long, owner long"), "sums")


def _sums_field(sums: DataFrame, owned: bool = False) -> np.ndarray:
    """The bit field of the keys of ``sums``, or of who owns them."""

    def tasks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, owners = (batch.column(c).to_numpy().view(np.uint64) for c in ("key", "owner"))
            yield _bit_rows(_owned(keys, owners) if owned else keys)

    return _gathered(sums.select("key", "owner").mapInArrow(tasks, "place long, bits long"))


def _frequent_cells(table: DataFrame, fields: list[np.ndarray], least: int, group_bits: int) -> np.ndarray:
    """The bit field of the frequent phrases one word longer than there are fields."""
    return _sums_field(_sums(table, fields, least, group_bits))


def _chunk_ids(table: DataFrame) -> DataFrame:
    return table.select("lang", "hashes", "size", "ids")


def _of_chunks(batch: pa.RecordBatch) -> Iterator[tuple[np.uint64, str, np.ndarray, np.ndarray]]:
    """Each chunk's number, ``lang``, ``hashes`` and unpacked ``ids``.

    The number is a hash of the ids, so equal chunks may share one.
    """
    for i in range(batch.num_rows):
        hashes = batch.column("hashes")[i].values.to_numpy()
        size, packed = (batch.column(c)[i].as_py() for c in ("size", "ids"))
        number = np.uint64(xxhash.xxh64_intdigest(packed))
        yield number, batch.column("lang")[i].as_py(), hashes, unpacked(size, packed)


def _owned_phrases(table: DataFrame, fields: list[np.ndarray], owners: np.ndarray) -> DataFrame:
    """``lang, key`` and the words' hashes ``h0, h1, ...`` of phrases, each from its owner."""
    shared = table.sparkSession.sparkContext.broadcast((fields, owners))
    names = [f"h{i}" for i in range(len(fields) + 1)]

    def tasks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields, owners = shared.value
        for batch in batches:
            for chunk, lang, hashes, ids in _of_chunks(batch):
                rows, _ = count_phrases(lang, hashes, ids, fields, owners, chunk)
                for start in range(0, len(rows), 1 << 17):
                    part = rows[start : start + (1 << 17)]
                    keys = _keys(np.full(len(part), _start(lang)), part)
                    longs = [np.ascontiguousarray(x).view(np.int64) for x in (keys, *part.T)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(part)), *map(pa.array, longs)], ["lang", "key", *names]
                    )

    kinds = f"lang string, key long, {', '.join(f'{n} long' for n in names)}"
    return _chunk_ids(table).mapInArrow(tasks, kinds)


def _counted(table: DataFrame, fields: list[np.ndarray], sums: DataFrame) -> DataFrame:
    """``lang, phrase, f`` of the phrases of ``sums``, one word longer than there are fields."""
    found = _owned_phrases(table, fields, _sums_field(sums, owned=True))
    names = found.columns[2:]
    # The field may let a second chunk give a phrase.
    each = sums.select("key", "f").join(found, "key").distinct()
    return written(each.select("lang", F.array(*names).alias("phrase"), "f"), "phrases")


# Scores.


def _exact(column: Column) -> Column:
    return column.cast("decimal(20,0)")


def _scored(candidates: DataFrame, parts: DataFrame, longest: int, scale: int) -> DataFrame:
    """``lang, phrase, f, l, r, score`` of each candidate by its lowest-scoring cut."""
    size = F.size("phrase")
    cut = candidates.select("lang", "phrase", "f", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    sides = F.array(
        F.struct(F.lit(0).alias("side"), F.slice("phrase", 1, F.col("k")).alias("part")),
        F.struct(F.lit(1).alias("side"), F.slice("phrase", F.col("k") + 1, size - F.col("k")).alias("part")),
    )
    sought = cut.select("lang", "phrase", "f", "k", F.inline(sides))
    known = parts.select("lang", F.col("phrase").alias("part"), F.col("f").alias("count"))
    met = sought.join(known, ["lang", "part"])
    totals = [
        F.max(F.when((F.col("k") == k) & (F.col("side") == side), F.col("count"))).alias(f"{name}{k}")
        for k in range(1, longest)
        for side, name in enumerate("lr")
    ]
    each = met.groupBy("lang", "phrase", "f").agg(*totals)

    def scored(k: int) -> Column:
        l, r = F.col(f"l{k}"), F.col(f"r{k}")
        score = F.expr(f"cast(f as decimal(20,0)) * {scale} div (cast(l{k} as decimal(20,0)) + r{k})")
        # Of equal scores the smallest k comes first.
        return F.when(l.isNotNull(), F.struct(score.alias("score"), F.lit(k).alias("k"), l.alias("l"), r.alias("r")))

    lowest = F.array_min(F.filter(F.array(*(scored(k) for k in range(1, longest))), F.isnotnull))
    return each.select("lang", "phrase", "f", lowest.alias("best")).select("lang", "phrase", "f", "best.*")


def _uncovered(scored: DataFrame, longer: DataFrame, longest: int, covered: int) -> DataFrame:
    """Candidates but for those that a longer one around them mostly accounts for."""
    inner = [
        F.when(F.size("phrase") >= start + length - 1, F.slice("phrase", start, length))
        for length in range(2, longest)
        for start in range(1, longest - length + 2)
    ]
    # A part of the whole length is the phrase itself and left out.
    parts = F.filter(F.array(*inner), lambda x: F.isnotnull(x) & (F.size(x) < F.size("phrase")))
    around = (
        longer.select("lang", F.explode(parts).alias("phrase"), F.col("f").alias("outer"))
        .groupBy("lang", "phrase")
        .agg(F.max("outer").alias("outer"))
    )
    met = scored.join(around, ["lang", "phrase"], "left")
    goes = _exact(F.col("outer")) * 100 >= _exact(F.col("f")) * covered
    return met.where(F.col("outer").isNull() | ~goes).drop("outer")


def _spelled(rows: DataFrame, table: DataFrame) -> DataFrame:
    """``rows`` with the words of ``phrase`` instead of their hashes."""
    needed = rows.select("*", F.posexplode("phrase").alias("place", "hash"))
    wanted = needed.select("hash").distinct()
    # A chunk gives the words in the field only, so that few others are shuffled.
    shared = table.sparkSession.sparkContext.broadcast(
        _field(wanted.select(F.lit("").alias("lang"), F.array("hash").alias("phrase")))
    )

    def tasks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, words = (pc.list_flatten(batch.column(c)) for c in ("hashes", "words"))
            keys = hashes.to_numpy(False).view(np.uint64)
            inside = pa.array(_inside(shared.value, _longer(np.full(len(keys), _start("")), keys)))
            yield pa.RecordBatch.from_arrays([hashes.filter(inside), words.filter(inside)], ["hash", "word"])

    words = (
        table.select("hashes", "words")
        .mapInArrow(tasks, "hash long, word string")
        .join(wanted, "hash", "left_semi")
        .groupBy("hash")
        .agg(F.min("word").alias("word"))
    )
    others = [c for c in rows.columns]
    joined = needed.join(words, "hash").groupBy(*others).agg(
        F.sort_array(F.collect_list(F.struct("place", "word"))).alias("spelled")
    )
    return joined.withColumn("phrase", F.array_join("spelled.word", " ")).drop("spelled")


# The operator.


def collocations(
    docs: DataFrame,
    least: int = LEAST,
    longest: int = LONGEST,
    top: int = TOP,
    covered: int = COVERED,
    scale: int = SCALE,
    text_column: str = "text",
    lang_column: str = "lang",
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """The ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    Texts are lowered from A to Z and cut into pieces at ``. , ; : ! ?`` and line ends, and
    pieces into words at spaces and tabs. Phrases are two to ``longest`` words in turn
    within a piece, found ``least`` times or more in a language, overlaps counted (``a``).
    A phrase cut in two has the counts ``l`` and ``r`` of its parts and the score
    ``floor(scale * a / (l + r))``; its lowest-scoring cut counts, of equal ones the first.
    Phrases inside a longer one with ``covered`` hundredths of their count are left out.
    Order is by score and ``a`` falling, then by phrase. ``n`` counts the language's words.

    A null language is ``und``, a null or empty text has no words, and every row counts, also
    when rows repeat. Long texts count whole. Languages without such phrases, and empty
    tables, have no rows. Only the two named columns are read.
    """
    lang = F.coalesce(docs[lang_column].cast("string"), F.lit(UNKNOWN)).alias("lang")
    table = _written_chunks(docs.select(lang, docs[text_column].alias("text")), chunk_bytes)
    pairs = F.explode(F.arrays_zip("hashes", "counts")).alias("w")
    words = (
        table.select("lang", pairs)
        .groupBy("lang", F.col("w.hashes").alias("hash"))
        .agg(F.sum("w.counts").alias("f"))
        .where(F.col("f") >= least)
    )
    frequent = [written(words.select("lang", F.array("hash").alias("phrase"), "f"), "words")]
    places = table.agg(F.sum("size")).first()[0] or 0
    group_bits = max(1, (places // GROUP_PLACES).bit_length())
    fields = [_field(frequent[0])]
    for length in range(2, longest + 1):
        sums = _sums(table, fields, least, group_bits)
        frequent.append(_counted(table, fields, sums))
        if length < longest:
            fields.append(_sums_field(sums))

    def union(tables: list[DataFrame]) -> DataFrame:
        out = tables[0]
        for other in tables[1:]:
            out = out.union(other)
        return out

    scored = _scored(union(frequent[1:]), union(frequent[:-1]), longest, scale)
    if longest > 2:
        scored = _uncovered(scored, union(frequent[2:]), longest, covered)
    # Each of a bounded number of groups gives its best, ties included, before one ranks them.
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    order = [F.desc("score"), F.desc("f")]
    best = scored.withColumn("place", F.rank().over(Window.partitionBy("lang", salt).orderBy(*order)))
    best = written(best.where(F.col("place") <= top).drop("place", "k"), "best")
    total = F.aggregate("counts", F.lit(0).cast("long"), lambda a, b: a + b)
    totals = table.groupBy("lang").agg(F.sum(total).alias("n"))
    named = _spelled(best, table)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase"))
    ranked = named.withColumn("rank", rank).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", F.col("f").alias("a"), "l", "r", "n", "score"
    )
