from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ringledger.llm import phrases
from ringledger.llm.phrases import by_rank, collocations, count_pairs
from tests.conftest import DATA, physical_plan


def brute_force(rows, least=30, longest=4, top=2000, covered=80):
    counts, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang or "und"
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    counts[lang][tuple(words[i : i + size])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        around = Counter()
        for p, a in candidates.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    around[p[i : i + size]] = max(around[p[i : i + size]], a)
        ranked = []
        for p, a in candidates.items():
            if not 100 * around[p] >= covered * a:
                cuts = [(2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                ranked.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.collect())


@given(
    st.lists(st.tuples(st.integers(0, 700), st.integers(0, 700)), max_size=400),
    st.integers(0, 9000),
)
@settings(max_examples=60, deadline=None)
def test_tiles_count_every_pair(pairs, crowd):
    """Few entries everywhere, and a crowd in one tile, which is counted densely."""
    pairs = pairs + [(i % 7, i % 11) for i in range(crowd)]
    a, b = np.array([p[0] for p in pairs], int), np.array([p[1] for p in pairs], int)
    x, y, n = count_pairs(a, b)
    assert Counter(pairs) == dict(zip(zip(x.tolist(), y.tolist()), n.tolist()))
    assert len(set(zip(x.tolist(), y.tolist()))) == len(n)


def test_the_crowd_is_counted_densely(monkeypatch):
    calls = []
    plain = np.bincount
    monkeypatch.setattr(phrases.np, "bincount", lambda *a, **b: calls.append(b) or plain(*a, **b))
    count_pairs(np.arange(9000) % 7, np.arange(9000) % 11)
    assert calls == [{"minlength": 1 << 16}]


def test_ranks_follow_frequency():
    ids = np.array([3, 3, 3, -1, 1, 1, 0, 2, 2, 2, 2])
    ranks, order = by_rank(ids, np.array([True, False, True, True]))
    assert order.tolist() == [2, 3, 0]
    assert ranks.tolist() == [1, 1, 1, -1, -1, -1, 2, 0, 0, 0, 0]


def test_the_bit_field_holds_what_was_put_in(spark):
    hashes = np.random.default_rng(1).integers(0, 1 << 62, 4000).astype(np.uint64)
    table = spark.createDataFrame(
        [("en", [int(h)]) for h in hashes[:2000]], "lang string, phrase array<long>"
    )
    field = phrases._field(table)
    keys = phrases._longer(np.full(4000, phrases._start("en")), hashes)
    inside = phrases._inside(field, keys)
    assert inside[:2000].all() and inside[2000:].mean() < 0.01
    other = phrases._longer(np.full(4000, phrases._start("de")), hashes)
    assert phrases._inside(field, other).mean() < 0.01
    assert not phrases._field(table.limit(0)).any()


WORDS = ["a", "b", "c", "New", "york", "x.y", "café", "É", "a,", "b!"]


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("chunk_bytes", [100, 1 << 20])
def test_random_texts_by_brute_force(spark, seed, chunk_bytes):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(60):
        words = rng.choice(WORDS, rng.integers(0, 60), p=[0.3, 0.2] + [0.0625] * 8)
        gaps = rng.choice([" ", "  ", "\t", "\n", "\r\n", " . "], len(words))
        rows.append((["en", "de", None][i % 3], "".join(w + g for w, g in zip(words, gaps))))
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = collocations(docs, least=5, top=25, chunk_bytes=chunk_bytes)
    expected = brute_force(rows, least=5, top=25)
    assert len(expected) > 20 and found(got) == expected


def test_a_full_bit_field_changes_no_result(spark, monkeypatch):
    """A field so small that all bits are set lets every phrase pass; the sums decide."""
    monkeypatch.setattr(phrases, "_inside", lambda field, keys: np.ones(len(keys), bool))
    rows = [("en", "a b c d e f " * 20), ("en", "a b c x y z"), ("de", "a b " * 3)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert found(collocations(docs, least=4)) == brute_force(rows, least=4)


def test_longest_of_two_and_of_five(spark):
    rows = [("en", "one two three four five six " * 9)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    for longest in (2, 3, 5):
        got = found(collocations(docs, least=8, longest=longest))
        assert got == brute_force(rows, least=8, longest=longest)


def test_whole_table_by_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet").select("lang", "text")
    expected = brute_force([tuple(r) for r in docs.collect()])
    assert len(expected) > 100 and found(collocations(docs)) == expected


def test_odd_rows_and_names(spark, odd_docs, no_docs):
    rows = [(r["lang"], r["text"]) for r in odd_docs.collect()]
    got = found(collocations(odd_docs, least=3))
    assert got and got == brute_force(rows, least=3)
    assert collocations(no_docs).collect() == []
    nulls = spark.createDataFrame([(None, None), ("en", "")], "lang string, text string")
    assert collocations(nulls).collect() == []


def test_scores_are_exact_where_products_pass_64_bits(spark):
    big = 5 * 10**13
    table = "lang string, phrase array<long>, f long"
    pairs = spark.createDataFrame([("en", [1, 2], big)], table)
    words = spark.createDataFrame([("en", [1], big + 1), ("en", [2], 3 * big)], table)
    row = phrases._scored(pairs, words, 2, 2_000_000).first()
    assert row["score"] == 2_000_000 * big // (4 * big + 1) and (row["l"], row["r"]) == (big + 1, 3 * big)


def test_joins_shuffle_on_their_own_keys(spark, conf):
    """No aggregate shares the shuffle of a join, so adaptive execution may split hot words."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    table = spark.createDataFrame([("en", [1, 2], 5)], "lang string, phrase array<long>, f long")
    plan = physical_plan(phrases._scored(table, table, 3, 100))
    join = plan[plan.index("SortMergeJoin") :]
    assert "HashAggregate" not in join and join.count("Exchange hashpartitioning") == 2


def test_rare_phrases_of_frequent_words_are_not_spelled_out(spark):
    """Pairs of 40 frequent words, nearly all of them rare: only the frequent one is a row."""
    rng = np.random.default_rng(6)
    rows = [("en", " ".join(["ab cd", *(f"w{i}" for i in rng.permutation(40))])) for _ in range(40)]
    docs = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    table = phrases.written(phrases.chunks(docs, 2000), "chunks")
    field = np.full(1 << (phrases.FIELD_BITS - 6), ~np.uint64(0))
    cells = phrases._frequent_cells(table, [field], 30, 3)
    chunk = table.first()
    ids, hashes = phrases.unpacked(chunk['size'], chunk.ids), np.array(chunk.hashes, np.int64)
    everything, _ = phrases.count_phrases("en", hashes, ids, [field])
    chosen, counts = phrases.count_phrases("en", hashes, ids, [field], cells)
    words = dict(zip(hashes.view(np.uint64).tolist(), chunk.words))
    assert [[words[h] for h in row] for row in chosen.tolist()] == [["ab", "cd"]]
    assert len(everything) > 100 and counts[0] > 1


@given(st.dictionaries(st.integers(0, 2**40 - 1), st.integers(1, 2**33)))
@settings(max_examples=40, deadline=None)
def test_packed_cells_come_back(cells):
    values = np.array(sorted(cells), np.uint64)
    counts = np.array([cells[v] for v in sorted(cells)], np.uint64)
    a, b = phrases._unpacked(len(values), phrases._packed(values, counts))
    assert np.array_equal(a, values) and np.array_equal(b, counts)


def test_a_frequent_phrase_is_a_row_of_one_chunk_only(spark, conf):
    """Every chunk has the same frequent phrases, in an order of its own."""
    conf("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    rng = np.random.default_rng(8)
    names = [f"p{i} q{i} r{i}" for i in range(50)]
    rows = [("en", ". ".join(names[i] for i in rng.permutation(50))) for _ in range(80)]
    docs = spark.createDataFrame(rows, "lang string, text string").coalesce(2)
    table = phrases.written(phrases.chunks(docs, 500), "chunks")
    assert table.count() == 40
    full = np.full(1 << (phrases.FIELD_BITS - 6), ~np.uint64(0))
    for words, fields in ((2, [full]), (3, [full, full])):
        sums = phrases._sums(table, fields, 30, 3)
        given = phrases._owned_phrases(table, fields, phrases._sums_field(sums, owned=True))
        assert given.count() == sums.count() == 50 * (4 - words)
        counted = phrases._counted(table, fields, sums).collect()
        assert {(len(r.phrase), r.f) for r in counted} == {(words, 80)} and len(counted) == 50 * (4 - words)
    owners = Counter(r.owner for r in sums.collect())
    assert len(owners) > 10, owners


def test_equal_chunks_give_a_phrase_once(spark, conf):
    conf("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    rows = [("en", "a b c d"), ("de", "a b c d"), ("de", "w x y z")] * 40
    docs = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    got = collocations(docs, chunk_bytes=1)
    assert found(got) == brute_force(rows) and len(found(got)) == 3


@given(st.lists(st.tuples(st.integers(0, 9), st.integers(1, 2**40)), min_size=1, max_size=60))
@settings(max_examples=60, deadline=None)
def test_frequent_sums_and_one_of_their_entries(entries):
    keys = np.array([k for k, _ in entries], np.uint64)
    counts = np.array([n for _, n in entries], np.uint64)
    total = Counter()
    for key, n in entries:
        total[key] += n
    found_, sums, entry = phrases._frequent_sums(keys, counts, 2**40)
    assert dict(zip(found_.tolist(), sums.tolist())) == {k: n for k, n in total.items() if n >= 2**40}
    assert keys[entry].tolist() == found_.tolist()
