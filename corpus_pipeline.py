"""A training corpus from raw documents: each stage is one operator, its result a written table that the next one reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import common, op1_bpe, op2_quality, op4_ngram_join, op7_pii, op10_decontaminate


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op2_quality.stage(spark, docs, sf_dir)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op4_ngram_join.stage(spark, docs, sf_dir)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op10_decontaminate.stage(spark, docs, sf_dir)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op7_pii.stage(spark, docs, sf_dir)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op1_bpe.stage(spark, docs, sf_dir)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("tokens", tokens),
]
#: Learned scores, near-duplicate classes and a BPE vocabulary are beyond SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table. Rows: doc_id, n_tokens, ids_sha256, decoded_sha256 of what is left."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.persist(stage(spark, docs, sf_dir), name)
    return docs
