"""The registered query of each operator, with SQL where it can express the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plugtide.llm import ann, divergence, exact, html, lm, neardup, packing, pieces, quality, search, secrets, substrings, tokens
from plugtide.llm.oracles import ORACLE_SQL as ORACLE_SQL

TOKEN_LIMIT = 2048


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(_read(spark, sf_dir, "pages"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(_read(spark, sf_dir, "documents"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_read(spark, sf_dir, "documents"), shingle=3, percent=85)


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_read(spark, sf_dir, "embeddings"), every=50, neighbours=5)


def op6_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    segmented = pieces.segment_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return segmented.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "lossless", "ids")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(_read(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = tokens.count_tokens(_read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(_read(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeated_passages(_read(spark, sf_dir, "documents"), window=50).drop("removed_spans")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"), top=20)


def op13_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_quality_classifier,
        op2_html_extraction,
        op3_secret_scan,
        op4_near_dedup,
        op5_nearest_neighbours,
        op6_merge_dropout,
        op7_exact_dedup,
        op8_token_counts,
        op9_lm_scoring,
        op10_packing,
        op11_substring_dedup,
        op12_ranked_search,
        op13_divergence_audit,
    )
}
