"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from skyledger.llm import (
    bpe,
    centroid_search,
    decontaminate,
    doubling_dedup,
    fingerprints,
    language_mixture,
    neardup,
    ngram_rules,
    quality_trees,
    suffix_dedup,
    url_rules,
    warc,
    whitening,
)

RANKS = "byte_bpe_multi_50k.tiktoken"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op1_quality_trees(spark: SparkSession, folder: str) -> DataFrame:
    return quality_trees.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op2_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.span_digests(table(spark, folder, "documents"))


def op3_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    return url_rules.judge(table(spark, folder, "pages"), table(spark, folder, "labels"))


def op4_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, folder, "documents"))


def op5_doubling_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return doubling_dedup.word_digests(table(spark, folder, "documents"))


def op6_ngram_rules(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_rules.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op7_language_mixture(spark: SparkSession, folder: str) -> DataFrame:
    return language_mixture.identify(table(spark, folder, "documents"))


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(table(spark, folder, "pages"))


def op10_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.token_digests(
        table(spark, folder, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    )


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


def op12_centroid_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return centroid_search.cluster(table(spark, folder, "embeddings"))


def op13_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_trees": op1_quality_trees,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_url_rules": op3_url_rules,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_doubling_dedup": op5_doubling_dedup,
    "op6_ngram_rules": op6_ngram_rules,
    "op7_language_mixture": op7_language_mixture,
    "op8_decontamination": op8_decontamination,
    "op9_warc": op9_warc,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_whitening": op11_whitening,
    "op12_centroid_clusters": op12_centroid_clusters,
    "op13_fingerprints": op13_fingerprints,
}
