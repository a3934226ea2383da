from __future__ import annotations

import pytest

LONG = " ".join(f"word{i % 997}" for i in range(30_000))
TEXTS = [
    "",
    None,
    " \t\n",
    "one",
    "the same text of several words, twice\nwith a line\nwith a line",
    "the same text of several words, twice\nwith a line\nwith a line",
    "### $$$ 123 !!!",
    "Ünïcödé wörds und Zeilen\r\n\r\nmehr davon",
    LONG,
]
#: Names that the operators use inside, or add.
CLASHING = ["row", "doc", "id", "a", "b", "key", "node", "size", "shard", "slot", "score", "n",
            "n_lines", "lines", "same", "rest", "kept", "features", "held_out", "matches",
            "lang_key", "doc_text", "bands", "class_id", "hashes", "known", "none", "place"]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls everywhere, empty and long texts, repeated ids and rows, clashing names."""
    rows = [(i if i % 4 else None, text, "en" if i % 3 else None) for i, text in enumerate(TEXTS)]
    rows += [rows[4], rows[4], (7, "another text under a used id", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return df.selectExpr("*", "'s' as source", "7L as n_chars", *(f"'x' as `{c}`" for c in CLASHING))


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
