"""From raw documents to token ids: five stages, each on all that the one before it kept.

The first four take and return the columns of ``documents``; the last returns doc_id, n_tokens,
the digests of the ids and of the decoded bytes, and the ids. Null and repeated rows, empty texts
and empty tables are treated as each operator says.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import bpe, decontaminate, neardup, quality_trees, suffix_dedup
from skyledger.llm.queries import RANKS, table
from skyledger.session import write_shared

#: SQL can express neither the classifier nor the tokens; tests hold ``run`` against plain Python.
ORACLE_SQL = None
#: Any passage of over 50 words fills a window of so many, however short its words are.
REPEATED_WORDS = 51


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality_trees.keep_good(docs, table(spark, sf_dir, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group of near duplicates."""
    return neardup.keep_one(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated windows of 400 bytes or of ``REPEATED_WORDS`` words.

    n_chars is that of what is left.
    """
    cut = suffix_dedup.remove_repeats(docs, words=REPEATED_WORDS)
    return cut.withColumn("n_chars", F.coalesce(F.length("text").cast("bigint"), "n_chars"))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no copy of a benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and the digests of the ids and of what they decode to."""
    return bpe.token_digests(
        docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, with_ids=True
    )


STAGES = [
    ("quality_classifier", good_quality),
    ("near_duplicates", one_of_each_group),
    ("suffix_array_dedup", without_repeats),
    ("benchmark_decontamination", without_benchmark),
    ("byte_bpe", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = write_shared(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
