from __future__ import annotations

import gzip
import hashlib
import re


from skyledger.llm import queries, warc
from skyledger.llm.oracle import ORACLE_SQL
from skyledger.session import work_path
from tests.conftest import SMALL
from tests.oracle_check import connect, difference

COLUMNS = "page_id long, url string, html string, digest int, archive string"


def brute(rows, least=100):
    first = {}
    for page, _, html in rows:
        data = (html or "").encode()
        if len(data) >= least and page is not None:
            first[data] = min(page, first.get(data, page))
    found = []
    for page, _, html in rows:
        data = (html or "").encode()
        to = first.get(data) if len(data) >= least else None
        kind = "response" if to is None or to == page else "revisit"
        sha = hashlib.sha256(data).hexdigest()
        found.append((page, len(data), sha, kind, to if kind == "revisit" else None))
    return sorted(found, key=str)


def test_query_matches_oracle(spark):
    assert difference(queries.op9_warc(spark, SMALL), connect(SMALL), ORACLE_SQL["op9_warc"]) is None


def test_odd_pages(spark):
    long = "ü" * 1_700_000
    rows = [
        (3, "http://a/\r\nX: y", "x" * 99), (2, "http://b/", "x" * 99),
        (9, "u", "é" * 50), (4, "u", "é" * 50), (4, "u", "é" * 50), (7, None, "é" * 50),
        (None, "n", "é" * 50), (None, None, "alone " * 30), (5, "", None), (6, "", ""),
        (8, "l", long), (10, "l", long), (11, "w", "WARC/1.1\r\n\r\n\r\n\r\nWARC/1.0\r\n" * 9),
        (12, "w", "\x00\r\n\r\n" * 40),
    ]
    pages = spark.createDataFrame([(*r, 1, "q") for r in rows], COLUMNS)
    found = warc.round_trip(pages).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute(rows)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_chunk_rows_carry_running_digests(spark):
    rows = [(1, "u", "abc" * 1000), (2, "u", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    manifest = warc.write_archives(pages, work_path(spark, "warc-test"))
    chunks = warc.read_archives(manifest, chunk_bytes=1024)
    found = sorted((r.page_id, r.chunk_no, r.n_bytes, r.digest) for r in chunks.collect())
    data = b"abc" * 1000
    sizes = [(i, min(1024, 3000 - 1024 * i)) for i in range(3)]
    assert found == [
        *((1, i, n, hashlib.sha256(data[: 1024 * i + n]).hexdigest()) for i, n in sizes),
        (2, 0, 0, hashlib.sha256(b"").hexdigest()),
    ]


def test_archives_are_gzip_warc(spark):
    pages = spark.createDataFrame([(1, "http://a/", "é")], "page_id long, url string, html string")
    manifest = warc.write_archives(pages, work_path(spark, "warc-test"))
    [row] = manifest.collect()
    data = gzip.open(re.sub("^file:/*", "/", row.archive)).read()
    assert data.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n")
    assert data.endswith("Content-Length: 2\r\n\r\né\r\n\r\n".encode())
    assert row.n_records == 1
