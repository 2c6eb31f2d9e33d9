"""Prepare ``documents`` for training: judge, strip repeated lines, deduplicate, redact, pack."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from clickloom.llm.classifier import grades_of_labels, select_documents, train
from clickloom.llm.line_dedup import drop_removed_lines
from clickloom.llm.packing import pack_documents
from clickloom.llm.secret_scan import redact_secrets
from clickloom.llm.simhash import near_unique
from clickloom.workspace import materialise


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are probably of the top grade, by a model of the rated ones.

    Every row is judged by its own text, null as empty; repeated rows alike. Without
    ratings all stay; an empty table stays empty.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return select_documents(docs, train(docs, grades_of_labels(labels), max_rows=10_000))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that match one of an earlier row; documents left empty go.

    Rows are documents of their own, whatever their ids: repeated or null ids lose no text
    but their repeated lines. Null and empty texts, and an empty table, stay as they are.
    """
    return drop_removed_lines(docs, threshold=0.8)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the first as read.

    Rows are documents of their own, whatever their ids. Texts without a word are one group.
    """
    return near_unique(docs, shingle=3, distance=2)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark; null texts, ids and other columns stay."""
    return redact_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in token windows."""
    return pack_documents(
        docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, window=2048
    )


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

#: No stage of these can be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
