"""The registered queries of this subpackage, with production parameters, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import oracles
from clickloom.llm.alignment import align_documents
from clickloom.llm.bpe import encode_documents
from clickloom.llm.classifier import grades_of_labels, judge_documents, train
from clickloom.llm.licenses import find_licenses
from clickloom.llm.line_dedup import removed_lines
from clickloom.llm.merkle import verify_documents
from clickloom.llm.packing import pack_documents
from clickloom.llm.pii import find_personal_data
from clickloom.llm.rules import judge_quality
from clickloom.llm.secret_scan import find_secrets
from clickloom.llm.simhash import simhash_groups
from clickloom.llm.topk import top_k
from clickloom.llm.urls import judge_urls


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(
        _table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.PATTERN,
        keep_ids=False,
    )


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_licenses(_table(spark, sf_dir, "documents"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(
        _table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
        keep_ids=False,
    )


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(_table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removed_lines(_table(spark, sf_dir, "documents"), threshold=0.8)


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(_table(spark, sf_dir, "documents"), shingle=3, distance=2)


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = train(docs, grades_of_labels(_table(spark, sf_dir, "labels")), max_rows=10_000)
    return judge_documents(docs, model)


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(_table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(_table(spark, sf_dir, "documents"))


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_documents(
        _table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
        keep_groups=False,
    ).documents


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(_table(spark, sf_dir, "pages"), max_rows=10_000)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify_documents(_table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_packing,
        op2_license_scan,
        op3_byte_bpe,
        op4_secret_scan,
        op5_line_dedup,
        op6_exact_top_k,
        op7_simhash,
        op8_quality_classifier,
        op9_personal_data,
        op10_quality_rules,
        op11_tokenizer_alignment,
        op12_url_filter,
        op13_merkle_manifest,
    )
}

#: SQL for the queries that SQL can express.
ORACLES: dict[str, str] = {
    "op2_license_scan": oracles.OP2_LICENSE_SCAN,
    "op5_line_dedup": oracles.OP5_LINE_DEDUP,
    "op6_exact_top_k": oracles.OP6_EXACT_TOP_K,
    "op13_merkle_manifest": oracles.OP13_MERKLE_MANIFEST,
}
