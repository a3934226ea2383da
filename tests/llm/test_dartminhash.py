from __future__ import annotations

import itertools
import random
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from ringledger.llm import dartminhash
from ringledger.llm.components import components
from ringledger.llm.dartminhash import deduplicated, near_duplicates, prefix, signatures, similarity


def shingles(text):
    words = (text or "").encode().split()
    n = min(5, len(words))
    return Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if words else Counter()


def jaccard(x, y):
    both = sum((x & y).values())
    every = sum(x.values()) + sum(y.values()) - both
    return both / every if every else 0.0


def classes_by_brute_force(rows, least=0.8):
    sets = [shingles(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] or "") == (rows[j][1] or "") or jaccard(sets[i], sets[j]) >= least:
                root[find(i)] = find(j)
    ids: dict[int, list] = {}
    for i, (doc_id, _) in enumerate(rows):
        ids.setdefault(find(i), []).append(doc_id)
    smallest = {r: min((x for x in own if x is not None), default=None) for r, own in ids.items()}
    return Counter((rows[i][0], smallest[find(i)]) for i in range(len(rows)))


def made(rng, groups=40, copies=8):
    rows = []
    for g in range(groups):
        base = [f"w{rng.randrange(2000)}" for _ in range(rng.randrange(3, 120))]
        for _ in range(rng.randrange(1, copies)):
            text = list(base)
            for _ in range(rng.randrange(0, 6)):
                text[rng.randrange(len(text))] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(text)))
    return rows


def test_agreement_is_the_weighted_similarity():
    rng = np.random.default_rng(5)
    for share in (0.3, 0.6, 0.9):
        hashes = rng.integers(1, 2**63, 400, dtype=np.uint64)
        weights = rng.integers(1, 4, 400)
        other = weights.copy()
        other[: int(400 * (1 - share))] = rng.integers(0, 2, int(400 * (1 - share)))
        x = np.unique(hashes), weights[np.argsort(hashes)]
        y_all = np.unique(hashes), other[np.argsort(hashes)]
        y = y_all[0][y_all[1] > 0], y_all[1][y_all[1] > 0]
        a, b = signatures([x, y], 2000)
        assert abs((a == b).mean() - similarity(x, y)) < 0.05


def test_fractional_weights():
    hashes = np.arange(1, 301, dtype=np.uint64)
    x, y = (hashes, np.full(300, 0.5)), (hashes, np.full(300, 1.0))
    a, b = signatures([x, y], 2000)
    assert abs((a == b).mean() - 0.5) < 0.05


def test_a_signature_does_not_depend_on_its_neighbours():
    rng = np.random.default_rng(2)
    sets = [(np.unique(rng.integers(1, 2**62, n, dtype=np.uint64)),) for n in (1, 3, 50, 4000)]
    sets = [(h, np.ones(len(h), int)) for (h,) in sets]
    together = signatures(sets, 64)
    assert all((signatures([s], 64)[0] == row).all() for s, row in zip(sets, together))
    assert (together != 0).all()


def test_classes_by_brute_force(spark):
    rows = made(random.Random(4))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = Counter((r["id"], r["class_id"]) for r in near_duplicates(docs).collect())
    assert found == classes_by_brute_force(rows)


def test_no_link_is_lost_where_many_classes_share_a_passage(spark):
    """Buckets then hold hundreds of classes, most of them not similar enough."""
    rng = random.Random(9)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for _ in range(500):
        own = [f"o{rng.randrange(10**6)}" for _ in range(25)]
        for _ in range(rng.randrange(1, 4)):
            text = passage + own
            text[rng.randrange(len(text))] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = Counter((r["id"], r["class_id"]) for r in near_duplicates(docs).collect())
    assert found == classes_by_brute_force(rows)


def test_edits_of_one_text_by_brute_force(spark):
    """From near copies to texts that share half: many pairs lie close to the limit."""
    rng = random.Random(11)
    words = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(300):
        text = list(words)
        for _ in range(rng.randrange(12)):
            text[rng.randrange(150)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = Counter((r["id"], r["class_id"]) for r in near_duplicates(docs).collect())
    assert found == classes_by_brute_force(rows)


@given(st.integers(0, 10**6), st.sampled_from([0.5, 0.8, 0.95]))
@settings(max_examples=40, deadline=None)
def test_the_prefix_filter_loses_no_pair(seed, least):
    """Of any two similar sets the heavier's first shingles and the lighter's few share one
    from which on both have the weight needed in common, in whatever order they are put."""
    rng = np.random.default_rng(seed)
    base = rng.integers(1, 2**63, 60, dtype=np.uint64)
    counts = rng.integers(0, 4, dartminhash.CELLS)
    sets = []
    for _ in range(12):
        keep = rng.random(60) < rng.choice([0.8, 0.95, 1.0])
        hashes = np.unique(np.r_[base[keep], rng.integers(1, 2**63, rng.integers(0, 8), dtype=np.uint64)])
        sets.append((hashes, rng.integers(1, 4, len(hashes))))
    for x, y in itertools.combinations(sets, 2):
        if similarity(x, y) < least:
            continue
        heavy, light = (x, y) if x[1].sum() >= y[1].sum() else (y, x)
        h, before_h, _ = prefix(*heavy, counts, least)
        li, before_l, short = prefix(*light, counts, least)
        rest_h = dict(zip(h.tolist(), (heavy[1].sum() - before_h).tolist()))
        rest_l = dict(zip(li[:short].tolist(), (light[1].sum() - before_l)[:short].tolist()))
        needed = least / (1 + least) * (x[1].sum() + y[1].sum()) - 1e-6
        assert any(min(rest_h[c], rest_l[c]) >= needed for c in rest_h.keys() & rest_l.keys())


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(60)]
    random.Random(1).shuffle(path)
    star = [(1000 + i, 1000) for i in range(1, 200)]
    links = spark.createDataFrame(path + star + [(5000, 5000)], "a long, b long")
    found = dict(components(links).collect())
    assert found == {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(200)}
    assert components(links.limit(0)).collect() == []


def test_odd_rows_and_names(odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    found = Counter((r["id"], r["class_id"]) for r in near_duplicates(odd_docs).collect())
    assert found == classes_by_brute_force(rows)
    kept = deduplicated(odd_docs)
    assert kept.columns == odd_docs.columns
    texts = [r["text"] or "" for r in kept.collect()]
    assert sorted(texts) == sorted({text or "" for _, text in rows})
    assert deduplicated(no_docs).collect() == []
