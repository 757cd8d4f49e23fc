from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skyledger.llm import fingerprints, queries
from tests.conftest import SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = "doc_id long, text string, text_hash string, bucket int"


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = WORD.findall(low)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a or b else 1.0


def edits(rows):
    """(doc_id, text, edited text, next text) by plain Python."""
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    for (d, t), (_, u) in zip(rows, [*rows[1:], *rows[:1]]):
        yield d, t, t[: len(t) - len(t) // 2] + u[: len(t) // 2], u


def hold(found, rows, slack):
    """Found rows against plain Python: exact columns, and estimates within ``slack``."""
    found = {r.doc_id: r for r in found}
    want, off = list(edits(rows)), []
    assert len(found) == len(want) == len(rows)
    by_text = {}
    for d, t, edited, following in want:
        r = found[d]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        for text, print_ in ((t, r.fingerprint), (edited, r.edited_fingerprint)):
            assert by_text.setdefault(text, print_) == print_
            assert len(print_) == 16 * min(len(shingles(text)), fingerprints.K)
        for near, other in ((r.near_edited, edited), (r.near_next, following)):
            off.append(abs(near - jaccard(t, other)))
            if len(shingles(t) | shingles(other)) <= fingerprints.K or t == other:
                assert off[-1] < 1e-12
        exact = len(shingles(t))
        assert abs(r.shingles - exact) <= (0 if exact < fingerprints.K else 0.6 * exact)
        kept = len(shingles(t) & shingles(edited)) / exact if exact else 1.0
        if exact >= 20:
            assert abs(r.kept_share - kept) < 0.35
    assert max(off) < 0.3 and np.mean(off) < slack


def test_query_against_plain_python(spark):
    docs = queries.table(spark, SMALL, "documents").collect()
    hold(queries.op13_fingerprints(spark, SMALL).collect(), [(r.doc_id, r.text) for r in docs], 0.03)


def test_odd_documents(spark):
    rng = random.Random(4)
    text = lambda n: " ".join(f"longer{rng.randrange(400)}é" for _ in range(n))
    long = text(110_000)
    rows = [(3, text(200)), (-7, None), (9, ""), (None, text(9)), (1 << 62, "One  TWO\tthree"), (4, " \n"),
            (12, long), (11, long), (2, "🙂 " * 7), (-(1 << 62), text(60)), (13, "x" * 3_000_000)]
    docs = spark.createDataFrame([(*r, "a", 1) for r in rows], COLUMNS)
    hold(fingerprints.fingerprints(docs.repartition(5)).collect(), rows, 0.1)
    assert fingerprints.fingerprints(docs.limit(0)).count() == 0


def test_single_and_repeated_rows(spark):
    alone = spark.createDataFrame([(5, "a b c d e f g h", "a", 1)], COLUMNS)
    [row] = fingerprints.fingerprints(alone).collect()
    assert (row.near_next, row.edited_sha256) == (1.0, hashlib.sha256(b"a b c d a b c d"[:8] + b"a b c d").hexdigest())
    rows = [(5, "a b c d e f g h")] * 30 + [(6, "q r s")] * 3 + [(5, "z y x")]
    docs = spark.createDataFrame([(*r, "a", 1) for r in rows], COLUMNS).repartition(6)
    found = fingerprints.fingerprints(docs).collect()
    assert sorted((r.doc_id, r.n_chars) for r in found) == sorted((d, len(t)) for d, t in rows)


def test_result_does_not_depend_on_buckets(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(rng.randrange(-500, 500) * 3, " ".join(rng.choice("abcdef") for _ in range(rng.randrange(30))))
            for _ in range(300)]
    rows = list(dict(rows).items())
    results = []
    for parts, sampled in ((1, 1), (9, 1), (40, 32)):
        monkeypatch.setattr(fingerprints, "PER_BUCKET", sampled)
        docs = spark.createDataFrame([(*r, "a", 1) for r in rows], COLUMNS).repartition(parts)
        results.append(sorted(map(tuple, fingerprints.fingerprints(docs).collect())))
    assert results[0] == results[1] == results[2]


def test_many_rows_of_one_id_are_spread(spark):
    docs = spark.range(3000).select(F.lit(7).alias("doc_id"), F.expr("concat('t ', id)").alias("text"))
    ordered = fingerprints._in_order(docs.repartition(8))
    parts = ordered.where("borrowed = 0").groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) >= 6 and max(r["count"] for r in parts) < 900


@pytest.mark.parametrize("size", [40, 300, 5000])
def test_parts_of_long_texts_merge_to_the_same_sketch(size):
    rng = random.Random(size)
    texts = [" ".join(rng.choice(["a", "bb", "c" * rng.randrange(1, 90), "é"]) for _ in range(n))
             for n in (0, 1, 3, 4, 5, 6, 50, 900)] + ["x" * 700, "  ", "x" * 600 + " y z"]
    whole = fingerprints.sketch(pa.array(texts), 16)
    parts = fingerprints.sketch(pa.array(texts), 16, size)
    assert all((a == b).all() for a, b in zip(whole, parts, strict=True))


def test_sketches_of_groups(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(f"w{rng.randrange(30)}" for _ in range(rng.randrange(40)))) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    each = fingerprints.document_sketches(docs).withColumn("part", F.col("doc_id") % 3)
    found = {r.part: r.sketch for r in fingerprints.merged(each, "part").collect()}
    for part in range(3):
        own = {h for r in each.where(f"part = {part}").collect() for h in r.sketch}
        assert found[part] == sorted(own, key=lambda h: h % (1 << 64))[: fingerprints.K]


def test_estimates_of_columns(spark):
    words = [f"w{i}" for i in range(4000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:2000])), (3, ""), (4, "a b c")]
    each = fingerprints.document_sketches(spark.createDataFrame(rows, "doc_id long, text string"), 512)
    pairs = each.alias("a").join(each.alias("b"), F.expr("a.doc_id < b.doc_id OR a.doc_id = 3"))
    judged = fingerprints.estimates(F.col("a.sketch"), F.col("b.sketch"), 512)
    found = {(r[0], r[1]): r[2] for r in pairs.select("a.doc_id", "b.doc_id", judged).collect()}
    assert found[1, 2].resemblance == pytest.approx(0.5, abs=0.08)
    assert found[1, 2].n_first == pytest.approx(3996, rel=0.15)
    assert found[1, 3][:2] == (0, 0) and found[3, 4][:2] == (0, 1) and found[3, 3] == (1, 1, 0)


def test_words_that_collide_as_polynomials():
    a, b = "a", "b"
    for _ in range(10):
        a, b = a + b, b + a
    row, value = fingerprints.sketch(pa.array([a, b]))
    assert row.tolist() == [0, 1] and value[0] != value[1]
