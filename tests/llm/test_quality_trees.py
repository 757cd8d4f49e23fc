from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest

from skyledger.llm import quality_trees, queries
from skyledger.llm.text import slices

MEDIUM = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = queries.op1_quality_trees(spark, MEDIUM).collect()
    labels = queries.table(spark, MEDIUM, "labels").collect()
    assert len(rows) == queries.table(spark, MEDIUM, "documents").count()
    found = {r.doc_id: r for r in rows}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    test = [(found[r.doc_id].predicted, r.quality) for r in labels if found[r.doc_id].held_out]
    assert len(test) > 40 and np.mean([a == b for a, b in test]) > 0.95


def test_statistics_by_hand():
    texts = ["Ab c!\nAb c!\n\nxyz 12", "", None, "aa aa aa", "É%"]
    [part] = slices(pa.array(texts))
    table = quality_trees.statistics(part)
    of = lambda i, name: table[i, quality_trees.STATISTICS.index(name)]
    assert of(0, "log_words") == pytest.approx(np.log(7))
    assert of(0, "log_lines") == pytest.approx(np.log(5))
    assert of(0, "upper") == pytest.approx(2 / 19) and of(0, "digits") == pytest.approx(2 / 19)
    assert of(0, "repeated_lines") == pytest.approx(1 / 4)
    assert of(0, "distinct_words") == pytest.approx(4 / 6) and of(0, "longest_word") == 3
    assert of(3, "top_word") == 1 and of(3, "same_as_last") == pytest.approx(2 / 3)
    assert of(3, "repeated_pairs") == pytest.approx(1 / 2)
    assert of(4, "not_ascii") == pytest.approx(2 / 3) and of(4, "symbols") == pytest.approx(1 / 3)
    assert not table[1].any() and not table[2].any()


def test_slices_do_not_matter():
    texts = pa.array(["one two", "three\nfour", "", "Five " * 50, None, "x" * 300])
    [whole] = [quality_trees.statistics(p) for p in slices(texts)]
    parts = np.concatenate([quality_trees.statistics(p) for p in slices(texts, 8)])
    assert np.array_equal(whole, parts)


def test_trees_against_plain_traversal():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 5)).astype(np.float32)
    y = ((x[:, 0] > 0.2) ^ (x[:, 3] < -0.5)).astype(float)
    trees = quality_trees.fit(x, y)
    got = trees.score(x)
    assert ((got >= 0.5) == y).mean() > 0.97
    for i in range(0, 600, 97):
        total = trees.base
        for f, t, v in zip(trees.feature, trees.threshold, trees.value, strict=True):
            node = 0
            while node < len(f):
                node = 2 * node + (2 if x[i, f[node]] > t[node] else 1)
            total += v[node - len(f)]
        assert got[i] == pytest.approx(1 / (1 + np.exp(-total)))


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, 1.0), (2, "", 2.0), (None, "text here", 3.0), (4, "x " * 90_000, 4.0), (4, "a", 5.0),
         (4, "a", 5.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame(
        [(4, 1), (2, 0), (None, 1), (1, None), (77, 1), (2, 0)], "doc_id long, quality int"
    )
    for some in (labels, labels.limit(0), labels.where("quality = 1")):
        found = quality_trees.judge(docs, some).collect()
        assert len(found) == 6 and all(0 <= r.score <= 1 for r in found)
        kept = quality_trees.keep_good(docs, some)
        assert kept.columns == docs.columns
        assert kept.count() == sum(r.predicted for r in found)
    assert quality_trees.judge(docs.limit(0), labels).count() == 0
