from __future__ import annotations

import math
import re
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from skyledger.llm import ngram_rules, queries
from tests.conftest import SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def chained(words):
    """Spark's xxhash64 of some strings: each is hashed with the hash before as its seed."""
    seed = 42
    for word in words:
        seed = xxhash.xxh64_intdigest(word.encode(), seed)
    return seed


def buckets(words):
    pairs = zip(words, words[1:])
    both = [chained([w]) for w in words] + [chained(p) for p in pairs]
    return [h % 2**16 for h in both]


def base(text):
    text = text or ""
    words = WORD.findall(text)
    runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(runs)
    covered = {i + k for i, r in enumerate(runs) if often[r] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    found = (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"),
             len(lines) - len(set(lines)), len(covered))
    return (*found, len(words) < 10 or 100 * len(covered) > 20 * len(words))


def brute(docs, good):
    raw, target = Counter(), Counter()
    for d, text in docs:
        raw.update(b := buckets(WORD.findall(text or "")))
        if d in good:
            target.update(b)
    n_raw, n_target = raw.total() + 2**16, target.total() + 2**16
    found = []
    for d, text in docs:
        b = buckets(WORD.findall(text or ""))
        ratio = [math.log((target[x] + 1) / n_target) - math.log((raw[x] + 1) / n_raw) for x in b]
        facts = base(text)
        found.append((d, *facts, (not facts[-1]) and sum(ratio) >= -0.1 * len(b)))
    return sorted(found, key=str)


def run(docs, labels):
    return sorted((tuple(r)[:-1] for r in ngram_rules.judge(docs, labels).collect()), key=str)


def test_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in queries.table(spark, SMALL, "documents").collect()]
    labels = queries.table(spark, SMALL, "labels").collect()
    found = sorted((tuple(r)[:-1] for r in queries.op6_ngram_rules(spark, SMALL).collect()), key=str)
    assert found == brute(docs, {r.doc_id for r in labels if r.quality == 1})
    assert {r[-1] for r in found} == {True, False}


def test_native(spark):
    plan = queries.op6_ngram_rules(spark, SMALL)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_odd_rows(spark):
    texts = [None, "", " \t\n", "one", "a b c d e", "a b c d e a b c d e f g h i j", "z " * 30,
             "x\nx\n \ny\x0b\x0cx\nx", "  é ü #*$%&|<> 🙂", "q w e r t y " * 20_000,
             "1 2 3 4 5 6 7 8 9 10 11 12", "1 2 3 4 5 6 7 8 9 10 11 12\r", "a b a b a b a b a b a b"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "1 2 3 4 5 6 7 8 9 10"), (4, texts[4])]
    docs = spark.createDataFrame(
        [(*r, 1, "w") for r in rows], "doc_id long, text string, n_words int, words string"
    )
    labels = spark.createDataFrame(
        [(10, 1), (10, 1), (None, 1), (3, 0), (99, 1), (5, None)], "doc_id long, quality int"
    )
    assert run(docs, labels) == brute(rows, {10})
    assert run(docs, labels.limit(0)) == brute(rows, set())
    assert run(docs.limit(0), labels) == []


def test_every_trusted_document_counts(spark):
    """More good labels than any fixed number of ids once taken; a rare topic is one of them."""
    n = 20_001
    ids = spark.range(n).selectExpr("id AS doc_id")
    rare = ids.orderBy(F.xxhash64("doc_id").desc()).first().doc_id
    text = F.when(F.col("doc_id") == rare, " ".join(f"rare{i}" for i in range(12))).otherwise("a b c d e f g h i j")
    docs = ids.withColumn("text", text)
    labels = ids.withColumn("quality", F.lit(1))
    assert ngram_rules.weights(docs, labels).where("weight <> 0").count() == 0
    assert ngram_rules.judge(docs, labels).where("kept").count() == n
