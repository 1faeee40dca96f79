"""The corpus pipeline: from raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from plugtide.functions.durable import durable
from plugtide.llm import exact, neardup, packing, quality, secrets


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learned from the given labels, does not reject.

    Null and empty texts are scored like any other; without usable labels all rows go or all stay.
    """
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with equal texts; null and empty texts are equal. A row without an id
    stays only where its group has no id at all; of rows that repeat both id and text one stays."""
    return exact.drop_exact(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 or more on shingles of five words. Rows
    without an id, and texts without words, stay."""
    return neardup.drop_near(docs, shingle=5, percent=80)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are cut out of the texts; every document stays, null and empty texts as they are."""
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces of sequences of 2048 tokens; an empty or null text is its end token alone."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_classifier", keep_good),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("secret_scan", hide_secrets),
    ("packing", pack),
]

# The classifier's fit, the signatures and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read again by the next.

    Tables without rows, null ids, repeated rows and further columns pass as each stage says.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
