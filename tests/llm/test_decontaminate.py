from __future__ import annotations

import random

import numpy as np

from ringledger.llm.decontaminate import (
    Index,
    _hashes,
    decontaminated,
    edit_distance,
    find_items,
)


def words(text):
    return _hashes(text.encode().lower().split())


def slow_distance(item, text):
    """Fewest edits from the item to any run of the text, by the textbook table."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def test_edit_distance_by_brute_force():
    random.seed(3)
    for _ in range(200):
        item = [random.randrange(4) for _ in range(random.randrange(1, 9))]
        text = [random.randrange(4) for _ in range(random.randrange(0, 12))]
        found, _ = edit_distance(np.array(item), np.array(text, int))
        assert found == slow_distance(item, text)


def edited(item, edits, rng):
    out = list(item)
    for i in range(edits):
        at = rng.randrange(len(out))
        kind = rng.random()
        if kind < 0.5:
            out[at] = f"new{i}"
        elif kind < 0.75:
            del out[at]
        else:
            out.insert(at, f"more{i}")
    return out


def test_recall_at_the_allowed_distance():
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [[rng.choice(vocabulary) for _ in range(rng.randrange(8, 60))] for _ in range(150)]
    index = Index([(i, " ".join(item)) for i, item in enumerate(items)], 0.2)
    missed = wrong = 0
    for i, item in enumerate(items):
        noise = [rng.choice(vocabulary) for _ in range(100)]
        at = rng.randrange(100)
        text = noise[:at] + edited(item, int(0.2 * len(item)), rng) + noise[at:]
        found = {m["item_id"]: m for m in index.search(words(" ".join(text)))}
        missed += i not in found
        wrong += any(m["edits"] > 0.2 * len(items[m["item_id"]]) for m in found.values())
        assert index.search(words(" ".join(noise))) == []
    assert missed <= 1 and not wrong


def test_where_and_how_far(spark):
    item = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame(
        [(1, f"zero {item.upper()} eleven"), (2, item.replace("five", "5")),
         (3, item.replace("two three four", "")), (4, item[:20])],
        "doc_id long, text string",
    )
    benchmark = spark.createDataFrame([(7, item), (8, None), (9, "too short")], "item_id long, text string")
    rows = {r["doc_id"]: [tuple(m) for m in r["matches"]] for r in find_items(docs, benchmark).collect()}
    assert rows == {1: [(7, 1, 10, 0)], 2: [(7, 0, 10, 1)], 3: [], 4: []}
    kept = decontaminated(docs, benchmark)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {3, 4}


def test_blocks_of_items_find_the_same(spark, monkeypatch):
    from ringledger.llm import decontaminate

    items = [(i, " ".join(f"item{i} word{j}" for j in range(10))) for i in range(5)]
    docs = spark.createDataFrame([(1, items[0][1] + " " + items[4][1])], "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontaminate, "BLOCK", 2)
    (row,) = find_items(docs, benchmark).collect()
    assert sorted(m["item_id"] for m in row["matches"]) == [0, 4]


def test_odd_rows_and_names(spark, odd_docs, no_docs):
    items = [(None, "word1 word2 word3 word4 word5 word6 word7 word8 word9"), (2, None), (3, "")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = find_items(odd_docs, benchmark)
    assert found.columns == [c for c in odd_docs.columns if c != "matches"] + ["matches"]
    assert sum(len(r["matches"]) for r in found.collect()) == 1
    kept = decontaminated(odd_docs, benchmark)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count() - 1
    assert decontaminated(no_docs, benchmark).collect() == []
    assert decontaminated(odd_docs, benchmark.limit(0)).count() == odd_docs.count()
