"""The registered queries against their SQL, and the pipeline stage by stage."""

from __future__ import annotations

import re
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from ringledger.llm import queries as llm
from tests.conftest import DATA
from tests.llm.test_dartminhash import classes_by_brute_force
from tests.llm.test_line_dedup import brute_force
from tests.llm.test_perplexity import base_by_brute_force

FOLDER = f"{DATA}/sf0.001"


def test_all_are_registered():
    names = list(llm.queries())
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in names[:-1]] == list(range(1, 14))
    assert names[-1] == "pipeline"
    assert llm.queries().items() <= contract.queries().items()


@pytest.mark.parametrize("name", llm.oracle_sql())
def test_query_equals_its_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        duck.sql(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    expected = duck.sql(llm.oracle_sql()[name])
    rows = [tuple(r[c] for c in expected.columns) for r in llm.queries()[name](spark, FOLDER).collect()]
    assert rows and Counter(rows) == Counter(expected.fetchall())


def test_each_stage_by_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, given = docs.columns, docs.collect()
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / str(number)))
        docs = spark.read.parquet(str(tmp_path / str(number)))
        kept = docs.collect()
        if number < 4:
            assert docs.columns == columns
        if number == 0:
            passed = [r for r in given if not base_by_brute_force(r["text"])[-1]]
            assert {r["doc_id"] for r in kept} <= {r["doc_id"] for r in passed}
            assert len(kept) >= 0.8 * len(passed)
        elif number == 1:
            expected = brute_force([r["text"] for r in given], 10)
            assert {(r["doc_id"], r["text"]) for r in kept} == {
                (r["doc_id"], text) for r, (text, _, _) in zip(given, expected)
            }
        elif number == 2:
            classes = classes_by_brute_force([(r["doc_id"], r["text"]) for r in given])
            assert sorted(r["doc_id"] for r in kept) == sorted({c for _, c in classes})
        elif number == 3:
            items = [r["text"] for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
            leaks = {r["doc_id"] for r in given if any(t in r["text"] for t in items)}
            assert leaks and leaks == {r["doc_id"] for r in given} - {r["doc_id"] for r in kept}
        else:
            assert {r["doc_id"] for r in kept} == {r["doc_id"] for r in given}
        given = kept


@pytest.mark.parametrize("number", range(5))
def test_stages_on_odd_rows(spark, odd_docs, no_docs, number):
    """Nulls, repeated rows, names that clash with those an operator adds, and no rows."""
    stage = corpus_pipeline.STAGES[number][1]
    found = stage(spark, odd_docs, FOLDER)
    rows = found.collect()
    if number < 4:
        assert found.columns == odd_docs.columns
        clashing = [c for c in odd_docs.columns[5:]]
        assert all(r[c] == "x" for r in rows for c in clashing)
    if number == 1:
        assert len(rows) == odd_docs.count()
    assert stage(spark, no_docs, FOLDER).collect() == []


def test_the_rest_works_without_this_subpackage(tmp_path):
    """In a copy of the repository without the two folders and the pipeline."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    here = Path(contract.__file__).parent
    skip = shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__")
    shutil.copytree(here, tmp_path / "copy", ignore=skip)
    code = "import __spark_entry__ as e; print(len(e.queries()), sorted(e.oracle_sql()) == sorted(e.queries()))"
    done = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path / "copy",
                          capture_output=True, text=True, check=True, env={"PATH": "/usr/bin:/bin"})
    assert done.stdout.split() == [str(len(contract.report_queries())), "True"]
