"""Drop lines that many documents share.

Lines are exploded as hashes of their normalised text, each hash is counted once per
document, and documents are put together again from the positions that stay. All of it
is DataFrame functions. Lines are hashed once, into a small table. Only hashes and positions
are exploded and shuffled; a text moves once, to meet its own list of positions. The
occurrences of a line that very many documents share are dealt to several tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringledger.functions.skew import spread_join
from ringledger.llm.rows import Passed
from ringledger.llm.storage import written

MIN_DOCUMENTS = 10
MIN_CODE_POINTS = 1

_SPACE = " \t\n\x0b\f\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def line_key(line: Column) -> Column:
    """The line without ASCII white space at both ends, A-Z in lower case."""
    bare = F.btrim(line, F.lit(_SPACE))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    # lower() is far faster than translate(), and the same where all letters are ASCII.
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, _UPPER, _UPPER.lower()))


def _fingerprint(text: Column) -> Column:
    """128 bits: two 64-bit hashes with different seeds."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))


def drop_shared_lines(
    docs: DataFrame,
    min_documents: int = MIN_DOCUMENTS,
    min_code_points: int = MIN_CODE_POINTS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``docs`` with shared lines removed from the text, plus ``n_lines`` and ``n_dropped``.

    A line is shared if its key (``line_key``) has ``min_code_points`` or more and occurs
    in ``min_documents`` or more documents. Every row is a document, also when ids or
    whole rows repeat; a null id is an id like any other. A null or empty text is one
    empty line, so it comes back as an empty text. A document whose lines all go keeps an
    empty text. An empty table gives an empty table. Other columns pass through; a column
    named ``n_lines`` or ``n_dropped`` is replaced.
    """
    text = F.coalesce(docs[text_column], F.lit(""))
    others = [c for c in docs.columns if c not in (text_column, "n_lines", "n_dropped")]
    # Rows with equal id and text lose the same lines, so that pair identifies the work.
    same = F.struct(F.xxhash64(docs[id_column]).alias("id"), _fingerprint(text).alias("text"))
    lines = F.split(text, "\n", -1)

    def fingerprint_or_null(line: Column) -> Column:
        key = line_key(line)
        return F.when(F.char_length(key) >= min_code_points, _fingerprint(key))

    hashed = docs.select(same.alias("same"), F.transform(lines, fingerprint_or_null).alias("keys"))
    hashed = written(hashed, "lines")
    shared = (
        hashed.select(F.explode(F.array_distinct("keys")).alias("key"))
        .where("key is not null")
        .groupBy("key.a", "key.b")
        .agg(F.count(F.lit(1)).alias("documents"))
        .where(F.col("documents") >= min_documents)
        .select("a", "b")
    )
    # Repeated rows would list their positions once each, so the lists are sets.
    places = (
        hashed.select("same", F.posexplode("keys").alias("position", "key"))
        .where("key is not null")
        .select("same", "position", "key.a", "key.b")
    )
    dropped = (
        spread_join(places, written(shared, "shared"), ["a", "b"], "left_semi")
        .groupBy("same")
        .agg(F.collect_set("position").alias("dropped"))
    )
    # The lines are split below the join, or each lookup of a line would split them again.
    passed = Passed(docs, others, "rest")
    rows = docs.select(same.alias("same"), lines.alias("lines"), passed.struct)
    joined = rows.join(dropped, "same", "left").select(
        "lines",
        "rest",
        F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"),
    )
    # array_except() looks positions up in a hash set, so long documents stay linear.
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("dropped"))
    kept = F.transform(stay, lambda i: F.get(F.col("lines"), i))
    columns = {c: passed.get(c) for c in others}
    columns[text_column] = F.array_join(kept, "\n")
    return joined.select(
        *(columns[c].alias(c) for c in docs.columns if c in columns),
        F.size("lines").cast("long").alias("n_lines"),
        F.size("dropped").cast("long").alias("n_dropped"),
    )
