"""Corpus pipeline over ``documents``: quality filter, one document of each
group of near copies, removal of benchmark leaks, redaction of secrets, and
packing into token windows. Every stage works on all rows its predecessor
kept; each result is written as Parquet and read again by the next.

All stages but the last return the columns they were given (``documents``),
whatever else they are called. Null, empty, blank and very long texts go
through every stage as its operator's module defines; rows without a
``doc_id`` are never near copies of others and stay; rows repeated with the
same id and text stay once, rows that share only the id are documents of
their own. Of linked documents (a tie) the smallest id stays. An empty table
stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridwake.llm.decontaminate import drop_contaminated
from gridwake.llm.jaccard_join import keep_one_of_each_group
from gridwake.llm.packing import pack
from gridwake.llm.quality import keep_quality
from gridwake.llm.secrets import redact
from gridwake.llm.tables import fresh_name, materialise, read_table, release


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine does not reject."""
    return keep_quality(docs, read_table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at 0.8."""
    return keep_one_of_each_group(docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage that aligns with a benchmark item."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked; ``n_chars`` follows the new text."""
    before = fresh_name(docs, "_before")
    masked = redact(docs.withColumn(before, F.col("text")))
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.when(F.col("text") != F.col(before), F.length("text"))
                                   .otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return masked.select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in 2048-token sequences."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("leaks", leaks),
    ("secrets", secrets),
    ("packing", packing),
]

# trained models and token ids: SQL cannot express the stages; tests/llm checks them by brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
        release(before)
    return STAGES[-1][1](spark, docs, sf_dir)
