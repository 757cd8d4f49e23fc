"""URL filters: a fixed list of rules first, then association rules mined from labels.

Every url becomes a set of tokens: host labels with their place from the right, path segments
and names of query parameters; runs of digits count as one token. Transactions are the token sets
of labelled pages, a page's label being bad if its document is toxic or of low quality. Spark's
FP-growth mines frequent combinations; rules that lead to bad are kept if confidence and support
suffice and no rule with fewer tokens is as confident. Tokens that labelled pages always have
together are one item of a transaction, or every subset of them would be a rule; such an item is
met by any of its tokens, as the rules of the single tokens would be. Rules are pruned level by
level, each against those one item shorter, never all against all. They match pages through an
inverted index: each rule lies under its rarest item, and the few that meet a page there are held
against its whole set.

Defined cases: a null url, or one without ``://``, has an empty host and path and no tokens, and
is allowed; an empty path fits no rule; null ids are never labelled; a page with conflicting
labels is bad; a long url with many tokens costs as much as its distinct items, which still is
exponential where many tokens occur in ever different combinations above the support; rows that repeat come out as often as they come in; columns other than
page_id and url are ignored; without labels no rules are mined; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.session import drop_paths, write_shared

#: The rules (verdict, host, path) in order.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

MIN_SUPPORT = 0.002
MIN_CONFIDENCE = 0.6
BAD = "label=bad"


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def listed(page_host: Column, page_path: Column) -> Column:
    """(rule, verdict) of the longest rule that fits, else null."""
    best = F.lit(None).cast("struct<rule: string, verdict: string>")
    for verdict, rule_host, rule_path in sorted(RULES, key=lambda r: len(r[1] + r[2])):
        fits = (page_host == rule_host) | page_host.endswith("." + rule_host)
        best = F.when(
            fits & page_path.startswith(rule_path),
            F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict")),
        ).otherwise(best)
    return best


def tokens(page_host: Column, page_path: Column, url: Column) -> Column:
    """The distinct tokens of a url."""
    number = lambda x: F.regexp_replace(x, "[0-9]+", "0")
    labels = F.reverse(F.split(page_host, r"\."))
    hosts = F.transform(
        labels, lambda x, i: F.concat(F.lit("host"), i.cast("string"), F.lit("="), number(x))
    )
    segments = F.transform(F.split(page_path, "/"), lambda x: F.concat(F.lit("path="), number(x)))
    query = F.split(F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1), "&")
    names = F.transform(
        query, lambda x: F.concat(F.lit("query="), number(F.substring_index(x, "=", 1)))
    )
    every = F.concat(hosts, segments, names)
    return F.array_distinct(F.filter(every, lambda x: ~x.endswith("=")))


def parsed(pages: DataFrame) -> DataFrame:
    """page_id, host, path and tokens of each page."""
    return pages.select("page_id", "url").select(
        "page_id",
        host(F.col("url")).alias("host"),
        path(F.col("url")).alias("path"),
        tokens(host(F.col("url")), path(F.col("url")), F.col("url")).alias("tokens"),
    )


def together(sets: DataFrame) -> DataFrame:
    """(item, members) of the distinct token sets: tokens that lie in the same sets are one item.

    Sets are told apart by 128 bits of the sums of their hashes; the item is the smallest token.
    """
    whole = lambda seed: F.xxhash64(F.lit(seed), "tokens").cast("decimal(20,0)")
    return (
        sets.select(F.explode("tokens").alias("token"), whole(1).alias("a"), whole(2).alias("b"))
        .groupBy("token")
        .agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.count("*").alias("n"))
        .groupBy("a", "b", "n")
        .agg(F.min("token").alias("item"), F.sort_array(F.collect_set("token")).alias("members"))
        .select("item", "members")
    )


def mine(
    pages: DataFrame,
    labels: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """(rule_id, antecedent, members, confidence, support) of the kept rules for bad pages.

    ``members`` has the tokens of each item of the antecedent.
    """
    spark = pages.sparkSession
    bad = (
        labels.where("doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL)")
        .groupBy(F.col("doc_id").alias("label_id"))
        .agg(F.max(F.expr("ifnull(quality = 0, false) OR ifnull(toxic = 1, false)")).alias("bad"))
    )
    known, known_path = write_shared(
        pages.join(bad, F.col("page_id") == F.col("label_id")).select("tokens", "bad"), "labelled"
    )
    sets = known.select("tokens").distinct()
    items, items_path = write_shared(together(sets), "items")
    short = (
        sets.select("tokens", F.explode("tokens").alias("item"))
        .join(items.select("item"), "item")
        .groupBy("tokens")
        .agg(F.collect_set("item").alias("items"))
    )
    mark = F.when(F.col("bad"), F.array(F.lit(BAD))).otherwise(F.array().cast("array<string>"))
    found = F.coalesce("items", F.array().cast("array<string>"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=0.0).fit(
        known.join(short, "tokens", "left").select(F.concat(found, mark).alias("items"))
    )
    # Every part of a rule is among these, confident or not.
    rules, rules_path = write_shared(
        model.associationRules.where(F.col("consequent") == F.array(F.lit(BAD))).select(
            F.sort_array("antecedent").alias("antecedent"), "confidence", "support"
        ),
        "rules",
    )
    kept = pruned(rules, min_confidence)
    members = (
        kept.select("antecedent", F.posexplode("antecedent").alias("place", "item"))
        .join(items, "item")
        .groupBy("antecedent")
        .agg(F.sort_array(F.collect_list(F.struct("place", "members"))).alias("placed"))
        .select("antecedent", F.col("placed.members").alias("members"))
    )
    done, _ = write_shared(
        kept.join(members, "antecedent").withColumn("rule_id", F.xxhash64("antecedent")), "kept-rules"
    )
    drop_paths(spark, [known_path, items_path, rules_path])
    return done


def pruned(rules: DataFrame, min_confidence: float) -> DataFrame:
    """Confident rules without those that have a part that is as confident, itself a rule.

    ``rules`` holds the parts of each of its rules. A level of rules of one size meets the level
    below it alone, which carries the best confidence of all that lies below.
    """
    spark = rules.sparkSession
    sizes = rules.agg(F.max(F.size("antecedent")).alias("most")).first()
    one = rules.where(F.size("antecedent") == 1).withColumn("below", F.lit(-1.0))
    levels, paths = [one], []
    for size in range(2, (sizes.most or 0) + 1):
        last = levels[-1].select(
            F.col("antecedent").alias("part"),
            F.greatest(
                "below",
                F.when(F.col("confidence") >= min_confidence, F.col("confidence")).otherwise(-1.0),
            ).alias("best"),
        )
        level = rules.where(F.size("antecedent") == size)
        parts = level.select("antecedent", F.explode("antecedent").alias("item")).select(
            "antecedent", F.array_remove("antecedent", F.col("item")).alias("part")
        )
        below = parts.join(last, "part").groupBy("antecedent").agg(F.max("best").alias("below"))
        written, path = write_shared(level.join(below, "antecedent"), "rule-level")
        levels.append(written)
        paths.append(path)
    every = levels[0]
    for level in levels[1:]:
        every = every.unionByName(level)
    kept, _ = write_shared(
        every.where((F.col("confidence") >= min_confidence) & (F.col("confidence") > F.col("below")))
        .drop("below"),
        "pruned-rules",
    )
    drop_paths(spark, paths)
    return kept


def fired(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """(fired_tokens, confidence): the distinct token sets some rule fires on, with the best confidence.

    A rule is indexed under the item that fewest pages have.
    """
    sets = pages.select("tokens").distinct()
    named = (
        rules.select(F.explode(F.arrays_zip("antecedent", "members")).alias("own"))
        .select(F.col("own.antecedent").alias("item"), F.explode("own.members").alias("token"))
        .distinct()
    )
    each = (
        sets.select("tokens", F.explode("tokens").alias("token"))
        .join(named, "token")
        .select("tokens", "item")
        .distinct()
    )
    counts = each.groupBy("item").count()
    index = (
        rules.select(
            "rule_id", "antecedent", "members", "confidence", F.explode("antecedent").alias("item")
        )
        .join(counts, "item")
        .groupBy("rule_id", "antecedent", "members", "confidence")
        .agg(F.min_by("item", F.struct("count", "item")).alias("item"))
    )
    whole = F.forall("members", lambda some: F.arrays_overlap(some, F.col("tokens")))
    return (
        each.join(index, "item")
        .where(whole)
        .groupBy(F.col("tokens").alias("fired_tokens"))
        .agg(F.max("confidence").alias("confidence"))
    )


def judge(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """page_id, host, path, rule and verdict of each row of ``pages``."""
    rows = parsed(pages)
    hits = fired(rows, mine(rows, labels))
    found = rows.withColumn("listed", listed(F.col("host"), F.col("path"))).join(
        hits, F.col("tokens") == F.col("fired_tokens"), "left"
    )
    mined = F.when(F.col("confidence").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return found.select(
        "page_id",
        "host",
        "path",
        F.col("listed.rule").alias("rule"),
        F.coalesce("listed.verdict", mined).alias("verdict"),
    )
