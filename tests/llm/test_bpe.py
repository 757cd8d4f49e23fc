from __future__ import annotations

import base64
import hashlib
import random
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from skyledger.llm import bpe, queries
from skyledger.llm.text import slices
from tests.conftest import SMALL

PATH = public_tokenizers.path(queries.RANKS)


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def expected(library, text):
    ids = np.array(library.encode_ordinary(text or ""), "<u4").tobytes()
    return (
        len(ids) // 4,
        hashlib.sha256(ids).hexdigest(),
        hashlib.sha256((text or "").encode()).hexdigest(),
    )


def test_every_document_as_the_library(spark, library):
    docs = queries.table(spark, SMALL, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = queries.op10_byte_bpe(spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r[1:]) == expected(library, texts[r.doc_id])


def test_odd_texts(spark, library):
    texts = [None, "", " ", "\x00", "aaa" * 50, "naïve 東京 🙂🙂 \n\n  x", "<|endoftext|>", "É" * 300,
             "a", "a", "it's 'LL 12345   \r\n\t!!??"]
    docs = spark.createDataFrame(
        [(i, t, i, "x") for i, t in enumerate(texts)],
        "doc_id long, text string, n_tokens int, ids string",
    )
    rows = bpe.token_digests(docs, PATH, public_tokenizers.PATTERN).collect()
    assert [tuple(r[1:]) for r in sorted(rows)] == [expected(library, t) for t in texts]
    wide = bpe.encode(docs, PATH, public_tokenizers.PATTERN).orderBy("doc_id").collect()
    assert [list(r.ids) for r in wide] == [library.encode_ordinary(t or "") for t in texts]
    assert bpe.token_digests(docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_long_text_and_repeated_rows(spark, library):
    text = "Ein langer Text, immer wieder. " * 60_000
    docs = spark.createDataFrame([(1, text), (1, text), (None, "b")], "doc_id long, text string")
    rows = bpe.token_digests(docs, PATH, public_tokenizers.PATTERN).collect()
    assert len(rows) == 3
    assert sum(tuple(r[1:]) == expected(library, text) for r in rows) == 2


def codec():
    with open(PATH, "rb") as file:
        return bpe.Codec(file.read(), public_tokenizers.PATTERN)


def test_long_pieces(library):
    rng = random.Random(4)
    texts = ["a" * 30_000, "=" * 7001 + "-" * 333 + "=" * 777, " " * 5000 + "x"]
    texts += ["".join(rng.choice(x) for _ in range(6000)) for x in ["etaoinshrdlu", "aab", "éß東a"]]
    texts.append("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(100_000)))
    own = codec()
    for text, ids in zip(texts, own.encode(texts), strict=True):
        assert ids == np.array(library.encode_ordinary(text), "<u4").tobytes()
    assert own._query_of_long() != bpe.ENCODE


def test_long_query_on_short_pieces(library, monkeypatch):
    """Both queries give the same ids, on pieces put together from whole tokens."""
    monkeypatch.setattr(bpe, "LONG_PIECE", 24)
    rng, own = random.Random(5), codec()
    words = [x for x in (t.decode(errors="ignore").strip() for t in own.ranks) if x.isalpha()]
    texts = ["".join(rng.choice(words) for _ in range(rng.randrange(1, 60))) for _ in range(60)]
    for text, ids in zip(texts, own.encode(texts), strict=True):
        assert ids == np.array(library.encode_ordinary(text), "<u4").tobytes()


def test_ranks_with_an_unreachable_token_take_one_pair_at_a_time():
    """``abc`` ranks below its part ``bc``, a merge that the long query leaves out."""
    tokens = [bytes([i]) for i in range(256)] + [b"abc", b"bc", b"de"]
    lines = (base64.b64encode(x) + b" " + str(i).encode() for i, x in enumerate(tokens))
    own = bpe.Codec(b"\n".join(lines), public_tokenizers.PATTERN)
    assert own._query_of_long() == bpe.ENCODE
    text = "abcde" * 300
    assert own.encode([text])[0] == np.array([256, 258] * 300, "<u4").tobytes()


def test_pieces_that_never_repeat_stay_within_a_worker(monkeypatch):
    with open(PATH, "rb") as file:
        codec = bpe.Codec(file.read(), public_tokenizers.PATTERN)
    monkeypatch.setattr(codec, "_contract", lambda words, query: (x[:8] * 2 for x in words))
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=8))
    texts = pa.array([" ".join(word() for _ in range(10_000)) for _ in range(150)])
    tracemalloc.start()
    for part in slices(texts, bpe.BYTES):
        codec.encode([part.bytes_of(i).decode() for i in range(len(part))])
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert most < 150e6
