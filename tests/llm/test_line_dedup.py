from __future__ import annotations

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ringledger.llm.line_dedup import drop_shared_lines
from tests.conftest import physical_plan


def brute_force(texts, least):
    def key(line):
        bare = line.strip(" \t\n\x0b\f\r")
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in bare)

    lines = [(text or "").split("\n") for text in texts]
    found = Counter(k for own in lines for k in {key(line) for line in own} if k)
    out = []
    for own in lines:
        kept = [line for line in own if not key(line) or found[key(line)] < least]
        out.append(("\n".join(kept), len(own), len(own) - len(kept)))
    return out


def run(spark, texts, least):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = drop_shared_lines(docs, min_documents=least).orderBy("doc_id").collect()
    return [(r["text"], r["n_lines"], r["n_dropped"]) for r in rows]


LINES = st.sampled_from(["a", " A\t", "É", "é", "", " ", "b b", "Zz\r", "\x0bzz", " a"])


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.lists(LINES, max_size=5).map("\n".join)), min_size=1, max_size=12))
def test_equals_brute_force(spark, texts):
    assert run(spark, texts, 3) == brute_force(texts, 3)


def test_a_line_counts_once_for_each_document(spark):
    texts = ["x\nx\nx", "x\ny", "y\ny"]
    assert run(spark, texts, 3) == [(text, text.count("\n") + 1, 0) for text in texts]


def test_odd_rows_and_names(odd_docs, no_docs):
    rows = drop_shared_lines(odd_docs, min_documents=3)
    assert rows.columns == [c for c in odd_docs.columns if c != "n_lines"] + ["n_lines", "n_dropped"]
    found = Counter((r["doc_id"], r["text"], r["n_dropped"]) for r in rows.collect())
    # The row that comes three times has its lines in four documents.
    assert found[(None, "", 3)] == 3 and found[(5, "", 3)] == 1
    assert found[(1, "", 0)] == 1
    assert drop_shared_lines(no_docs).collect() == []


def test_no_python(odd_docs):
    plan = physical_plan(drop_shared_lines(odd_docs))
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_a_hot_line_without_broadcast(spark):
    """A line that every document has, with the join's keys too large to be broadcast."""
    texts = [f"every\nown {i}\n\nevery \nsome {i % 50}" for i in range(400)]
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert run(spark, texts, 8) == brute_force(texts, 8)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
