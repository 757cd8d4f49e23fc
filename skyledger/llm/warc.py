"""WARC archives of web pages, written and read by Spark tasks, with revisit records.

Writing: payload digests are computed by Spark; of equal payloads of at least
``min_revisit_bytes`` the smallest ``page_id`` is stored and the others become revisit records
that refer to it. Every task streams its rows into one gzip archive, a member for each record,
on whatever store pyarrow can open, and returns a manifest row, which Spark commits; an archive
of an attempt that was lost is in no manifest and is never read.

Reading: a task streams the archives of its manifest rows and returns a chunked record table:
one row for each (archive, record number, chunk number) with at most ``chunk_bytes`` of payload
and the digest of the payload up to the end of that chunk. No record is ever held whole.
``records`` folds the chunks into one row a record.

Defined cases: a null html is an empty payload; a null url gets a URN; a null page_id is kept
as null, never chosen as the response of others, and revisits if its payload has a response.
Rows equal in page_id and payload are all of one type. An empty table gives no records.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.session import work_path, write_shared

CHUNK_BYTES = 1 << 20
MIN_REVISIT_BYTES = 100
#: gzip level: archives are scratch between two steps here, so speed matters more than size.
LEVEL = 1
_READ = 1 << 16

_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
CHUNK_SCHEMA = (
    "archive string, record_no bigint, page_id {}, record_type string, refers_to {},"
    " declared_bytes bigint, declared_digest string, chunk_no bigint, n_bytes bigint,"
    " digest string"
)


def record_types(pages: DataFrame, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Pages that revisit another: page_id, digest, refers_to."""
    html = F.coalesce(F.col("html"), F.lit(""))
    digests = pages.where(F.octet_length(html) >= min_revisit_bytes).select(
        "page_id", F.sha2(html, 256).alias("digest")
    )
    first = (
        digests.groupBy("digest")
        .agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n"))
        .where("n > 1 AND refers_to IS NOT NULL")
        .drop("n")
    )
    return (
        digests.join(first, "digest")
        .where("NOT (page_id <=> refers_to)")
        .select("page_id", "digest", "refers_to")
        .distinct()
    )


def _store(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The store of a path Spark knows, and the place in it; ``file:/x`` is ``/x``."""
    return pyarrow.fs.FileSystem.from_uri(re.sub("^file:/+", "/", path))


def _record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}')}>"


def _header(page_id, url, digest: str, refers_to, body: int) -> bytes:
    """The header of one record; control characters of a url are percent-encoded."""
    target = re.sub(
        r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or f"urn:page:{page_id}"
    )
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_record_id(page_id, digest)}",
        f"WARC-Target-URI: {target}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {body}",
    ]
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {_record_id(refers_to, digest)}",
            f"X-Refers-To-Page: {refers_to}",
        ]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def _write_record(out, page_id, url, payload: memoryview, digest: str, refers_to) -> None:
    http = _HTTP.format(len(payload)).encode()
    body = len(http) + (len(payload) if refers_to is None else 0)
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    out.write(packer.compress(_header(page_id, url, digest, refers_to, body) + http))
    if refers_to is None:
        for at in range(0, len(payload), CHUNK_BYTES):
            out.write(packer.compress(payload[at : at + CHUNK_BYTES]))
    out.write(packer.compress(b"\r\n\r\n") + packer.flush())


def _payloads(column: pa.Array) -> Iterator[memoryview]:
    """The bytes of each string, without copying them; null is empty."""
    column = column.cast(pa.large_string())
    view = memoryview(column.buffers()[2] or b"")
    ends = memoryview(column.buffers()[1]).cast("q")
    for i in range(len(column)):
        yield view[ends[column.offset + i] : ends[column.offset + i + 1]]


def write_archives(
    pages: DataFrame, folder: str, min_revisit_bytes: int = MIN_REVISIT_BYTES
) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives in ``folder``.

    Returns the manifest (archive, n_records), written to shared storage. Other columns of
    ``pages`` are ignored.
    """
    pages = pages.select("page_id", "url", "html")
    html = F.coalesce(F.col("html"), F.lit(""))
    types = record_types(pages, min_revisit_bytes).select(
        F.col("page_id").alias("own_id"), F.col("digest").alias("own_digest"), "refers_to"
    )
    rows = (
        pages.withColumn("digest", F.sha2(html, 256))
        .join(types, F.expr("page_id <=> own_id AND digest = own_digest"), "left")
        .select("page_id", "url", "html", "digest", "refers_to")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, count = None, "", 0
        for batch in batches:
            if out is None and batch.num_rows:
                store, place = _store(folder)
                store.create_dir(place, recursive=True)
                name = f"{uuid.uuid4().hex}.warc.gz"
                path = f"{folder}/{name}"
                out = store.open_output_stream(f"{place}/{name}", compression=None)
            ids, urls, _, digests, refers = (c.to_pylist() if i != 2 else None
                                             for i, c in enumerate(batch.columns))
            payloads = _payloads(batch.column(2))
            for row in zip(ids, urls, payloads, digests, refers, strict=True):
                _write_record(out, *row)
            count += batch.num_rows
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([path]), pa.array([count], pa.int64())], names=["archive", "n_records"]
            )

    manifest, _ = write_shared(
        rows.mapInArrow(write, "archive string, n_records bigint"), "warc-manifest"
    )
    return manifest


class _Archive:
    """Lines and bytes of a gzip archive, unpacked a block at a time."""

    def __init__(self, stream) -> None:
        self.stream, self.unpack, self.ready = stream, zlib.decompressobj(31), b""
        self.packed = b""

    def _more(self) -> bool:
        while True:
            if self.unpack.eof:
                self.packed = self.unpack.unused_data or self.packed
                self.unpack = zlib.decompressobj(31)
            block = self.packed or self.stream.read(_READ)
            self.packed = b""
            if not block:
                return False
            found = self.unpack.decompress(block, CHUNK_BYTES)
            self.packed = self.unpack.unconsumed_tail
            if found:
                self.ready += found
                return True

    def line(self) -> bytes:
        while b"\r\n" not in self.ready:
            if not self._more():
                found, self.ready = self.ready, b""
                return found
        found, _, self.ready = self.ready.partition(b"\r\n")
        return found

    def take(self, n: int) -> bytes:
        """The next bytes, at most ``n``; fewer only where the archive ends."""
        while len(self.ready) < n and self._more():
            pass
        found, self.ready = self.ready[:n], self.ready[n:]
        return found

    def headers(self) -> dict[str, str]:
        found = {}
        while line := self.line():
            name, _, value = line.decode().partition(": ")
            found[name.lower()] = value
        return found


def _chunks(archive: str, chunk_bytes: int) -> Iterator[tuple]:
    """The chunk rows of one archive, in order."""
    store, place = _store(archive)
    with store.open_input_stream(place, compression=None) as stream:
        source, number = _Archive(stream), 0
        while (version := source.line()) or source.ready:
            if not version.startswith(b"WARC/"):
                raise ValueError(f"{archive}: record {number} does not begin with WARC/")
            head = source.headers()
            source.line()
            http = source.headers()
            size, kind = int(http["content-length"]), head["warc-type"]
            digest = head["warc-payload-digest"].partition(":")[2]
            page, refers = head.get("x-page-id"), head.get("x-refers-to-page")
            fixed = (archive, number, page, kind, refers, size, digest)
            sha, left, chunk = hashlib.sha256(), size if kind == "response" else 0, 0
            while left or chunk == 0:
                data = source.take(min(left, chunk_bytes))
                if not data and left:
                    raise ValueError(f"{archive}: record {number} is cut off")
                left -= len(data)
                sha.update(data)
                yield (*fixed, chunk, len(data), sha.hexdigest())
                chunk += 1
            if source.take(4) != b"\r\n\r\n":
                raise ValueError(f"{archive}: record {number} has a wrong length")
            number += 1


def read_archives(
    manifest: DataFrame, id_type: str = "bigint", chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """The chunked record table of the archives in ``manifest`` (column ``archive``)."""
    n = max(1, manifest.count())
    names = ["archive", "record_no", "page_id", "record_type", "refers_to", "declared_bytes",
             "declared_digest", "chunk_no", "n_bytes", "digest"]
    schema = CHUNK_SCHEMA.replace("{}", "string")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                rows: list[tuple] = []
                for row in _chunks(archive, chunk_bytes):
                    rows.append(row)
                    if len(rows) == 10_000:
                        yield _batch(rows, names)
                        rows = []
                yield _batch(rows, names)

    chunks = manifest.select("archive").repartition(n).mapInArrow(read, schema)
    return chunks.withColumns(
        {c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")}
    )


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    numbers = {"record_no", "declared_bytes", "chunk_no", "n_bytes"}
    return pa.RecordBatch.from_arrays(
        [
            pa.array([r[i] for r in rows], pa.int64() if name in numbers else pa.string())
            for i, name in enumerate(names)
        ],
        names=names,
    )


def records(chunks: DataFrame) -> DataFrame:
    """One row a record: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Length and digest of a response are those of the payload that was read, and the digest is
    held against the one its header declares; a revisit has the ones it declares.
    """
    fold = chunks.groupBy("archive", "record_no").agg(
        *(F.first(c).alias(c) for c in ("page_id", "record_type", "refers_to")),
        F.first("declared_bytes").alias("declared_bytes"),
        F.first("declared_digest").alias("declared_digest"),
        F.sum("n_bytes").alias("n_bytes"),
        F.max_by("digest", "chunk_no").alias("digest"),
    )
    stored = F.col("record_type") == "response"
    checked = F.when(F.col("digest") == F.col("declared_digest"), F.col("digest")).otherwise(
        F.raise_error(F.concat(F.lit("payload differs from its digest in "), F.col("archive")))
    )
    return fold.select(
        "page_id",
        F.when(stored, F.col("n_bytes")).otherwise(F.col("declared_bytes")).alias("payload_bytes"),
        F.when(stored, checked).otherwise(F.col("declared_digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def round_trip(pages: DataFrame, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write ``pages`` as archives in the shared folder and read them back."""
    folder = work_path(pages.sparkSession, "warc")
    manifest = write_archives(pages, folder, min_revisit_bytes)
    id_type = pages.schema["page_id"].dataType.simpleString()
    return records(read_archives(manifest, id_type))
