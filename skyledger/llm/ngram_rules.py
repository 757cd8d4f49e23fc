"""Quality rules and a hashed n-gram log-likelihood ratio, in DataFrame functions alone.

Words and pairs of neighbouring words are hashed to 2**16 buckets. The raw-corpus multinomial
counts the buckets of every document; the trusted-target one those of every document labelled
good. A document's score is the mean over its n-grams of ln(target / raw), with add-one smoothing,
in whole millionths, so it does not depend on the order of rows. A document fails the base rules,
or is judged by a fixed threshold.

Only two things of fixed size are broadcast: a bitmap of the trusted ids (see ``prune``) and the
weights, a row for each bucket. Documents that hit the bitmap move to meet the trusted ids; the
others stay where they are. The n-grams of all documents are combined before each shuffle: to
2**16 counts, and to one row for each document.

Defined cases: null text has no words, and nothing but zeros; a document of fewer than ten words
fails; a null id is never trusted; rows that repeat come out as often as they come in; columns
other than doc_id and text are ignored; an empty table gives no rows; without trusted documents
every bucket has the same target share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.prune import key_bitmap, may_have, surely_not

BUCKETS = 1 << 16
UNIT = 1_000_000
#: Mean log-likelihood ratio, in millionths of a nat, from which a document is kept.
KEEP_FROM = -100_000

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
RUN = 5


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text that is not null."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, r"[\x20\x09-\x0D]+")
    )


def _sequence(first: int, last: Column) -> Column:
    """``first`` to ``last``, empty where ``last`` is smaller."""
    return F.when(last >= first, F.sequence(F.lit(first), last)).otherwise(
        F.array().cast("array<int>")
    )


def base_rules(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, ...) with ``words`` and the counts of the base rules."""
    text, w = F.col("__text"), F.col("words")
    at = lambda i, k: F.get(w, i + k)
    lines = F.filter(F.split("__text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    found = (
        docs.withColumn("__text", F.coalesce("text", F.lit("")))
        .withColumns({"words": words(text), "__lines": lines})
        .withColumns(
            {
                "n_words": F.size(w).cast("bigint"),
                "word_chars": F.length(_without(text, SPACES)).cast("bigint"),
                "n_symbols": (F.length(text) - F.length(_without(text, SYMBOLS))).cast("bigint"),
                "n_dup_lines": (
                    F.size("__lines") - F.size(F.array_distinct("__lines"))
                ).cast("bigint"),
                "__runs": F.transform(
                    _sequence(0, F.size(w) - RUN),
                    lambda i: F.xxhash64(*(at(i, k) for k in range(RUN))),
                ),
            }
        )
        .drop("__text", "__lines", "text")
    )
    runs, sorted_runs, places = F.col("__runs"), F.col("__sorted"), F.col("__places")
    repeated = F.size(F.array_distinct(runs)) < F.size(runs)
    of = lambda j: F.get(sorted_runs, j)["run"]
    place = lambda j: F.when(
        of(j).eqNullSafe(of(j - 1)) | of(j).eqNullSafe(of(j + 1)),
        F.get(sorted_runs, j)["place"],
    )
    spread = F.aggregate(
        F.sequence(F.lit(1), F.size(places) - 1),
        F.lit(RUN),
        lambda total, k: total + F.least(F.lit(RUN), F.get(places, k) - F.get(places, k - 1)),
    )
    numbered = F.transform(runs, lambda run, i: F.struct(run.alias("run"), i.alias("place")))
    return (
        found.withColumn("__sorted", F.when(repeated, F.sort_array(numbered)))
        .withColumn(
            "__places",
            F.when(
                F.col("__sorted").isNotNull(),
                F.sort_array(
                    F.filter(
                        F.transform(_sequence(0, F.size(sorted_runs) - 1), place),
                        lambda x: x.isNotNull(),
                    )
                ),
            ),
        )
        .withColumn(
            "n_repeat_words",
            F.when(places.isNotNull(), spread).otherwise(F.lit(0)).cast("bigint"),
        )
        .drop("__runs", "__sorted", "__places")
        .withColumn(
            "base_failed",
            F.expr("n_words < 10 OR 100 * n_repeat_words > 20 * n_words"),
        )
    )


def grams(w: Column) -> Column:
    """Buckets of the words and of the pairs of neighbours."""
    bucket = lambda h: F.pmod(h, F.lit(BUCKETS)).cast("int")
    return F.concat(
        F.transform(w, lambda x: bucket(F.xxhash64(x))),
        F.transform(
            _sequence(1, F.size(w) - 1), lambda i: bucket(F.xxhash64(F.get(w, i - 1), F.get(w, i)))
        ),
    )


def weights(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(bucket, weight): the log-likelihood ratio of each bucket in whole millionths."""
    target = (
        labels.where("quality = 1 AND doc_id IS NOT NULL")
        .select(F.col("doc_id").alias("trusted_id"))
        .distinct()
    )
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # As strings, ids of different whole-number types have equal hashes.
    key = lambda c: F.xxhash64(F.col(c).cast("string"))
    bitmap, _ = key_bitmap(target, key("trusted_id"))
    # The same join at every size.
    met = may_have(docs, key("doc_id"), bitmap).join(
        target.hint("merge"), F.col("doc_id") == F.col("trusted_id"), "left"
    )
    others = surely_not(docs, key("doc_id"), bitmap)
    marked = met.select("text", F.col("trusted_id").isNotNull().cast("int").alias("good")).union(
        others.select("text", F.lit(0).alias("good"))
    )
    counts = (
        marked.select("good", words(F.col("text")).alias("w"))
        .select("good", F.explode(grams(F.col("w"))).alias("bucket"))
        .groupBy("bucket")
        .agg(F.count("*").alias("raw"), F.sum("good").alias("target"))
    )
    all_buckets = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    counts = all_buckets.join(counts, "bucket", "left").select(
        "bucket",
        (F.coalesce("raw", F.lit(0)) + 1).alias("raw"),
        (F.coalesce("target", F.lit(0)) + 1).alias("target"),
    )
    # The window holds all rows, which are BUCKETS in number for any input.
    share = lambda c: F.log(F.col(c) / F.sum(c).over(Window.partitionBy()))
    return counts.select(
        "bucket", F.round((share("target") - share("raw")) * UNIT).cast("bigint").alias("weight")
    )


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def judge(docs: DataFrame, labels: DataFrame, keep_from: int = KEEP_FROM) -> DataFrame:
    """doc_id, the counts, base_failed, kept and the mean ratio in millionths, for each row."""
    docs = docs.select("doc_id", "text")
    each = (
        base_rules(docs)
        .withColumn("__row", F.monotonically_increasing_id())
        .withColumn("bucket", F.explode_outer(grams(F.col("words"))))
        .drop("words")
    )
    own = ["doc_id", *COUNTS, "base_failed"]
    scored = (
        each.join(F.broadcast(weights(docs, labels)), "bucket", "left")
        .groupBy("__row")
        .agg(
            *(F.max(c).alias(c) for c in own),
            F.coalesce(F.sum("weight"), F.lit(0)).alias("total"),
            F.count("bucket").alias("n"),
        )
    )
    enough = F.col("total") >= F.col("n") * keep_from
    return scored.select(
        *own,
        (~F.col("base_failed") & enough).alias("kept"),
        F.when(F.col("n") > 0, F.floor(F.col("total") / F.col("n"))).alias("llr_millionths"),
    )
