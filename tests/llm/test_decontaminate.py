from __future__ import annotations

import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa

from skyledger.llm import decontaminate as dc
from skyledger.llm import queries
from tests.conftest import SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def plain(item, text):
    """Smith-Waterman cell by cell."""
    above, best = [0] * (len(text) + 1), 0
    for x in item:
        cell = [0]
        for j, y in enumerate(text):
            cell.append(max(0, above[j] + (2 if x == y else -1), above[j + 1] - 1, cell[j] - 1))
        best, above = max(best, *cell), cell
    return best


def brute(docs, items):
    """All pairs, without seeds, by the vectorised alignment that a test holds against ``plain``."""
    code = {}
    number = lambda t: np.array([code.setdefault(w, len(code)) for w in words(t)], np.int64)
    texts = [number(t) for _, t in docs]
    found = set()
    for k, t in items:
        item = number(t)
        if len(item) < 8:
            continue
        some = [(d, x) for (d, _), x in zip(docs, texts, strict=True) if np.isin(item, x).sum() * 2 >= len(item)]
        for d, x in some:
            score = dc.align([item], [x])[0][0] / (2 * len(item))
            if score >= 0.5:
                found.add((d, k, round(float(score), 6)))
    return sorted(found, key=str)


def run(spark, docs, items):
    a = spark.createDataFrame([(*r, 1, 2) for r in docs], "doc_id long, text string, gram int, start int")
    b = spark.createDataFrame([(*r, 1.0) for r in items], "item_id long, text string, score double")
    return sorted({(r.doc_id, r.item_id, round(r.score, 6)) for r in dc.contaminated(a, b).collect()}, key=str)


def test_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in queries.table(spark, SMALL, "documents").collect()]
    items = [(r.item_id, r.text) for r in queries.table(spark, SMALL, "benchmark").collect()]
    found = queries.op8_decontamination(spark, SMALL).collect()
    got = sorted(((r.doc_id, r.item_id, round(r.score, 6)) for r in found), key=str)
    assert got == brute(docs, items) and got


def test_alignment_cell_by_cell():
    rng = random.Random(2)
    items = [[rng.randrange(5) for _ in range(rng.randrange(1, 12))] for _ in range(60)]
    texts = [[rng.randrange(5) for _ in range(rng.randrange(1, 25))] for _ in range(60)]
    score, end = dc.align([np.array(x) for x in items], [np.array(x) for x in texts])
    for i, t, s, e in zip(items, texts, score, end, strict=True):
        assert s == plain(i, t) == plain(i, t[:e])


def test_edited_copies(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(3000)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(15, 60)))) for i in range(25)]
    docs = []
    for i in range(200):
        text = rng.choices(vocabulary, k=rng.randrange(10, 300))
        if i % 2:
            copy = items[rng.randrange(25)][1].upper().split()
            for _ in range(rng.randrange(len(copy) // 3)):
                at = rng.randrange(len(copy))
                copy[at : at + rng.randrange(2)] = rng.choices(vocabulary, k=rng.randrange(3))
            text[5:5] = copy
        docs.append((i, " ".join(text)))
    got, want = run(spark, docs, items), brute(docs, items)
    assert got == want and 60 < len(want) < 130


def test_common_grams_and_odd_rows(spark):
    item = "one two three four five six seven eight nine ten"
    docs = [(i, f"{i} x {item} y") for i in range(80)]
    docs += [(100, None), (101, ""), (None, item), (102, item), (102, item), (102, "other"), (103, "one two three"),
             (104, (item + "\n") * 3000), (105, "one two three four six seven eight nine ten")]
    items = [(1, item), (1, item), (2, None), (3, ""), (None, "a b c d e f g h i"), (4, "one two three")]
    got = run(spark, docs, items)
    assert not set(got) ^ set(brute(docs, items)) and len(got) == 84
    assert run(spark, [], items) == [] and run(spark, docs, []) == []
    frame = spark.createDataFrame([(*d, 5) for d in docs], "doc_id long, text string, text_hash int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    left = dc.drop_contaminated(frame, bench)
    assert left.columns == frame.columns
    assert sorted(r.doc_id for r in left.collect()) == [100, 101, 102, 103]


def test_long_texts_piece_by_piece(spark):
    """Seeds all along a text of 200,000 words, and copies across the places where it is cut."""
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(2000)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(15, 60)))) for i in range(6)]
    reach = 2 * max(len(words(t)) for _, t in items) + dc.GRAM
    text = []
    while len(text) < 200_000:  # three words of an item every few words, never a whole copy
        copy = words(items[rng.randrange(6)][1])
        at = rng.randrange(len(copy) - 3)
        text += copy[at : at + 3] + rng.choices(vocabulary, k=12)
    spread = list(text)
    for i in range(5):  # the sixth item has no copy
        at = (40 * (i + 1) * dc.PIECE * reach) - 20
        spread[at : at + 1] = words(items[i][1])
    docs = [(1, " ".join(text)), (2, " ".join(spread)), (3, "none of it")]
    got = run(spark, docs, items)
    assert [g[:2] for g in got] == [(2, i) for i in range(5)] and {g[2] for g in got} == {1.0}


def test_cells_bound_the_memory():
    item, text = np.arange(40), np.arange(200_000) % 977
    batch = pa.RecordBatch.from_arrays(
        [pa.array([1] * 12), pa.array([2] * 12), pa.array([0] * 12),
         pa.array([text] * 12, pa.list_(pa.int32())), pa.array(range(12)),
         pa.array([item] * 12, pa.list_(pa.int32()))],
        names=["doc_id", "text_hash", "start", "words", "item_key", "item_words"],
    )
    tracemalloc.start()
    [found] = dc._scores(iter([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found["score"].to_pylist() == [1.0] * 12 and set(found["end_word"].to_pylist()) == {40}
    assert peak < 100e6
