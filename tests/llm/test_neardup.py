from __future__ import annotations

import random
import re

from skyledger.llm import neardup, queries
from skyledger.llm.graph import components
from skyledger.llm.oracle import ORACLE_SQL
from tests.conftest import SMALL
from tests.oracle_check import connect, difference

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows):
    sets = [(d, shingle_set(t)) for d, t in rows]
    up = {d: d for d, _ in sets}

    def find(d):
        while up[d] != d:
            d = up[d]
        return d

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and a is not None and b is not None and 4 * len(x & y) >= 3 * len(x | y):
                a_root, b_root = sorted((find(a), find(b)))
                up[b_root] = a_root
    return sorted(((d, len(s), find(d), find(d) == d) for d, s in sets), key=str)


def run(spark, rows):
    docs = spark.createDataFrame(
        [(*r, 5, "s") for r in rows], "doc_id long, text string, node int, component_id string"
    )
    return sorted((tuple(r) for r in neardup.near_duplicates(docs).collect()), key=str)


def edited(rng, words, share):
    return [rng.choice(["x", "yy", "zzz"]) + str(rng.random()) if rng.random() < share else w for w in words]


def test_query_matches_oracle(spark):
    found = queries.op4_near_duplicates(spark, SMALL)
    assert difference(found, connect(SMALL), ORACLE_SQL["op4_near_duplicates"]) is None


def test_groups_near_the_threshold(spark):
    rng = random.Random(5)
    rows, n = [], 0
    for _ in range(12):
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([6, 20, 80, 300]))]
        for share in [0, 0, 0.005, 0.01, 0.02, 0.03, 0.05, 0.1]:
            words = edited(rng, base, share) if share else base
            rows.append((n * 7 % 1009, " ".join(words)))
            n += 1
    assert run(spark, rows) == brute(rows)


def test_one_large_group_and_a_shared_passage(spark):
    rng = random.Random(6)
    base = [f"b{i}" for i in range(60)]
    rows = [(i, " ".join(base + [f"own{i}" for _ in range(rng.randrange(12))])) for i in range(150)]
    passage = [f"p{i}" for i in range(50)]
    rows += [
        (1000 + i, " ".join(passage + [f"q{rng.randrange(10**9)}" for _ in range(rng.randrange(8, 60))]))
        for i in range(150)
    ]
    assert run(spark, rows) == brute(rows)


def test_blocks_of_a_large_key(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 8)
    monkeypatch.setattr(neardup, "KEY_BLOCK", 8)
    rng = random.Random(7)
    passage = [f"p{i}" for i in range(50)]
    rows = [
        (i, " ".join(passage + [f"q{rng.randrange(10**9)}" for _ in range(rng.randrange(4, 30))]))
        for i in range(120)
    ]
    assert run(spark, rows) == brute(rows)


def test_group_on_both_sides_of_the_threshold(spark, monkeypatch):
    """Near copies of one text with few to many edits: links, near misses and chains."""
    rng = random.Random(8)
    base = [f"b{i}" for i in range(120)]
    rows = [(i, " ".join(edited(rng, base, rng.random() * 0.08))) for i in range(250)]
    assert len({r[2] for r in brute(rows)}) > 20
    assert run(spark, rows) == brute(rows)
    monkeypatch.setattr(neardup, "BLOCK", 40)
    assert run(spark, rows) == brute(rows)


def test_rows_dealt_grow_in_proportion(spark, monkeypatch):
    """A large group of near copies of one text: no pairs of blocks, one row a text and leader."""
    rng = random.Random(9)
    base = [f"b{i}" for i in range(200)]
    rows = [(i, " ".join([*base, f"own{rng.random()}"])) for i in range(600)]
    monkeypatch.setattr(neardup, "BLOCK", 30)
    sizes = []
    around, pairs = neardup._around_leaders, neardup._in_blocks

    def counted(deal):
        def run(dealt, key):
            if key != "label":
                return deal(dealt, key)
            sizes.append((deal.__name__, deal(dealt, key).count()))
            return deal(dealt, key)

        return run

    monkeypatch.setattr(neardup, "_around_leaders", counted(around))
    monkeypatch.setattr(neardup, "_in_blocks", counted(pairs))
    assert {r[2] for r in run(spark, rows)} == {0}
    assert sizes == [("_around_leaders", 600 + 19)]


def test_blocks_bounded_by_shingles(spark, monkeypatch):
    rng = random.Random(10)
    base = [f"b{i}" for i in range(300)]
    rows = [(i, " ".join(edited(rng, base, rng.random() * 0.05))) for i in range(60)]
    most = []
    inner = neardup._around_leaders

    def measured(dealt, key):
        found = inner(dealt, key)
        most.append(found.groupBy("label", "i").count().agg({"count": "max"}).first()[0])
        return found

    monkeypatch.setattr(neardup, "BLOCK_SHINGLES", 3000)
    monkeypatch.setattr(neardup, "_around_leaders", measured)
    assert run(spark, rows) == brute(rows)
    assert most[0] <= 25


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "ONE"), (6, "one two"), (None, "one"),
            (8, "one"), (8, "one"), (9, "É é"), (10, "é é"), (11, "a b c d e"), (12, "a b c d"),
            (13, "long " * 50_000 + "tail end of it")]
    rows.append((14, rows[-1][1] + " more"))
    assert run(spark, rows) == brute(rows)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert neardup.near_duplicates(empty).count() == 0


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame(
        [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (200, 200)],
        "a long, b long",
    )
    found = {r.node: r.label for r in components(edges).collect()}
    assert found == {i: 0 for i in range(41)} | {100: 100, 101: 100}


def colliding():
    """Two words that collide in every polynomial hash modulo a power of two."""
    a, b = "a", "b"
    for _ in range(10):
        a, b = a + b, b + a
    return a, b


def test_words_that_collide_as_polynomials(spark):
    a, b = colliding()
    rest = " ".join(f"w{i}" for i in range(12))
    rows = [(1, a), (2, b), (3, a + " x y z v"), (4, b + " x y z v"), (5, a), (6, f"{rest} {a}"),
            (7, f"{rest} {b} {b}"), (8, f"{a} {b} {a}"), (9, f"{b} {a} {b}")]
    assert run(spark, rows) == brute(rows)
