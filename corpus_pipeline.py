"""From raw documents to packed training sequences, in five stages.

Each stage is a function of (spark, docs, sf_dir). ``docs`` is what the stage before has
written; all stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringledger.llm import dartminhash, decontaminate, line_dedup, packing, perplexity
from ringledger.llm.storage import written
from ringledger.llm.tokens import tokenizer_file

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _plain(docs: DataFrame, operator: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The columns of ``docs`` after ``operator``, also those named like one that it adds."""
    names = {c: f"_{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text", "lang")}
    rows = operator(docs.withColumnsRenamed(names))
    return rows.select(*(F.col(names.get(c, c)).alias(c) for c in docs.columns))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie in the perplexity band of their language.

    Null and empty texts fail the base rules. Equal texts get the same verdict, and a null
    language is one of its own. Each row is judged by itself, also if rows repeat.
    """
    return _plain(docs, lambda rows: perplexity.quality_rules(rows).where("kept"))


def shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that ten or more of them share.

    Every row is a document, also if rows repeat; a null or empty text comes back empty.
    """
    return _plain(docs, line_dedup.drop_shared_lines)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return dartminhash.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.decontaminated(docs, benchmark)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences, with their ids."""
    return packing.pack(docs, tokenizer_file())


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("line dedup", shared_lines),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("packing", packed),
]

#: The stages count, hash and tokenize in ways that SQL cannot express; the tests compare
#: them to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``, each to the written result of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
