"""Byte-level BPE: encode texts to token ids and decode ids, by DuckDB inside each task.

Every task holds the merge table and the vocabulary in an in-memory DuckDB. Pieces that the
split pattern finds become rows (word, position, token); a recursive query joins each pair of
neighbours to the merge table and contracts every word's leftmost pair of lowest rank until
nothing can be merged. In a long piece every pair that is the lowest as far as a token can reach
contracts in the same round, which gives the same ids. Decoding joins (document, position, id) rows to the vocabulary and
aggregates the token bytes in order. Texts are worked through in slices of about a megabyte, and
the pieces a worker remembers are bounded, so memory does not grow with the input. Spark keeps a
worker for the tasks of later steps, so what it holds here counts beside theirs as well.

Defined cases: a null or empty text has no tokens, the ids and decoded bytes are empty; any
text decodes to its own UTF-8 bytes; repeated rows come out as often as they come in; other
columns are passed through or, in ``token_digests``, left out; an empty table stays empty.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.text import slices

#: Pieces given to one recursive query, and pieces a worker remembers (two generations).
QUERY_PIECES = 40_000
KEPT_PIECES = 200_000
DUCKDB_MEMORY = "256MB"
#: Bytes of text worked through at once: fewer make more queries, more take more memory.
BYTES = 1 << 20

#: Pieces of more bytes contract many pairs in a round, by ``ENCODE_LONG``.
LONG_PIECE = 512

#: One pair a word and round. Places are dense, so the next token is that of the next place.
ENCODE = """
WITH RECURSIVE state(k, tok, done) AS (
    SELECT (w::BIGINT << 32) | p, tok, false FROM tokens
    UNION ALL
    SELECT s.k - (CASE WHEN s.k > b.spot THEN 1 ELSE 0 END),
           CASE WHEN s.k = b.spot THEN b.merged ELSE s.tok END,
           b.spot IS NULL
    FROM (SELECT k, tok FROM state WHERE NOT done) s
    LEFT JOIN (
        SELECT w, (w << 32) | (best & 4294967295) AS spot, best >> 32 AS merged
        FROM (
            SELECT a.k >> 32 AS w, min((m.id::BIGINT << 32) | (a.k & 4294967295)) AS best
            FROM state a
            JOIN state n ON n.k = a.k + 1
            JOIN merges m ON m.pair = (a.tok::BIGINT << 32) | n.tok
            WHERE NOT a.done AND NOT n.done
            GROUP BY ALL
        )
    ) b ON b.w = s.k >> 32
    WHERE b.spot IS NULL OR s.k <> b.spot + 1
)
SELECT k >> 32 AS w, list(tok ORDER BY k) AS ids FROM state WHERE done GROUP BY ALL ORDER BY w
"""

#: Many pairs a round: those of lowest rank among all within {reach} places. A token has at most
#: {reach} bytes, so none from further away can grow up to such a pair before its turn. Pairs of
#: one rank in a row contract alternately from the left, once the whole row has its turn.
ENCODE_LONG = """
WITH RECURSIVE state(w, p, tok, done) AS (
    SELECT w, p, tok, false FROM tokens
    UNION ALL
    SELECT w, p, CASE WHEN chosen THEN id ELSE tok END, last
    FROM (
        SELECT *, coalesce(lag(chosen) OVER (PARTITION BY w ORDER BY p), false) AS taken
        FROM (
            SELECT w, p, tok, id, last,
                   coalesce(bool_and(id = best) OVER row_of, false)
                   AND (row_number() OVER (PARTITION BY w, run ORDER BY p)) % 2 = 1 AS chosen
            FROM (
                SELECT w, p, tok, id,
                       min(id) OVER (PARTITION BY w ORDER BY p
                                     ROWS BETWEEN {reach} PRECEDING AND {reach} FOLLOWING) AS best,
                       max(id) OVER (PARTITION BY w) IS NULL AS last,
                       sum(starts) OVER (PARTITION BY w ORDER BY p) AS run
                FROM (
                    SELECT *, (id IS DISTINCT FROM lag(id) OVER (PARTITION BY w ORDER BY p))::INT
                              AS starts
                    FROM (
                        SELECT w, p, tok,
                               lead(tok) OVER (PARTITION BY w ORDER BY p) AS next
                        FROM state WHERE NOT done
                    ) a
                    LEFT JOIN merges m
                    ON m.pair = (a.tok::BIGINT << 32) | a.next AND m.id > greatest(a.tok, a.next)
                )
            )
            WINDOW row_of AS (PARTITION BY w, run)
        )
    )
    WHERE NOT taken
)
SELECT w, list(tok ORDER BY p) AS ids FROM state WHERE done GROUP BY w ORDER BY w
"""

DECODE = """
SELECT d, string_agg(hex, '' ORDER BY p) AS hex
FROM ids JOIN vocabulary USING (id) GROUP BY d ORDER BY d
"""

_CODECS: dict[tuple[bytes, str], Codec] = {}


class Codec:
    """Merge table, vocabulary and split pattern of one rank file."""

    def __init__(self, ranks_file: bytes, pattern: str) -> None:
        import duckdb
        import regex

        lines = (line.split() for line in ranks_file.splitlines() if line)
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.pattern = regex.compile(pattern)
        settings = {"threads": 1, "memory_limit": DUCKDB_MEMORY, "temp_directory": ""}
        self.con = duckdb.connect(config=settings)
        pairs, ids = [], []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs.append(left << 32 | right)
                    ids.append(rank)
        table = pa.table({"pair": pa.array(pairs, pa.int64()), "id": pa.array(ids, pa.int32())})
        self._load("merges", table)
        hexes = [token.hex() for token in self.ranks]
        known = pa.table({"id": pa.array(self.ranks.values(), pa.int32()), "hex": hexes})
        self._load("vocabulary", known)
        self.single = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        self._long_query: str | None = None
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _load(self, name: str, table: pa.Table) -> None:
        self.con.register("incoming", table)
        self.con.execute(f"CREATE TABLE {name} AS FROM incoming")
        self.con.unregister("incoming")

    def _query_of_long(self) -> str:
        """``ENCODE_LONG`` if it is exact for these ranks, found out at the first long piece.

        It leaves out merges that rank below a part. If every token comes out of its own bytes
        without them, such a pair never meets: its bytes were one token before that part was.
        """
        if self._long_query is None:
            query = ENCODE_LONG.format(reach=max(map(len, self.ranks)))
            tokens = list(self.ranks)
            own = True
            for at in range(0, len(tokens), QUERY_PIECES):
                some = tokens[at : at + QUERY_PIECES]
                want = (self.ranks[x].to_bytes(4, "little") for x in some)
                own = own and all(map(bytes.__eq__, self._contract(some, query), want))
            self._long_query = query if own else ENCODE
        return self._long_query

    def _contract(self, words: list[bytes], query: str) -> Iterator[bytes]:
        """Ids of each word (little-endian unsigned 32 bits), merged by a recursive query."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        word = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
        place = np.arange(len(word)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        data = np.frombuffer(b"".join(words), np.uint8)
        tokens = pa.table({"w": word, "p": place.astype(np.int32), "tok": self.single[data]})
        self.con.register("tokens", tokens)
        ids = self.con.sql(query).to_arrow_table()["ids"].combine_chunks()
        self.con.unregister("tokens")
        flat = ids.values.to_numpy(zero_copy_only=False).astype("<u4").tobytes()
        ends = 4 * ids.offsets.to_numpy().astype(np.int64)
        return (flat[a:b] for a, b in zip(ends, ends[1:], strict=False))

    def _learn(self, pieces: set[str]) -> None:
        """Have the ids of all these pieces in ``recent``."""
        if len(self.recent) > KEPT_PIECES:
            self.recent, self.older = {}, self.recent
        unknown = []
        for piece in pieces:
            if piece in self.recent:
                continue
            if piece in self.older:
                self.recent[piece] = self.older[piece]
                continue
            data = piece.encode()
            if data in self.ranks:
                self.recent[piece] = self.ranks[data].to_bytes(4, "little")
            else:
                unknown.append(piece)
        long = [x for x in unknown if len(x) > LONG_PIECE]
        unknown = [x for x in unknown if len(x) <= LONG_PIECE]
        groups = [(unknown[at : at + QUERY_PIECES], ENCODE) for at in range(0, len(unknown), QUERY_PIECES)]
        # A long piece is a query of its own.
        groups += [([x], self._query_of_long()) for x in long]
        for some, query in groups:
            ids = self._contract([x.encode() for x in some], query)
            self.recent.update(zip(some, ids, strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        pieces = [self.pattern.findall(text) for text in texts]
        self._learn(set().union(*pieces))
        ids = self.recent.__getitem__
        return [b"".join(map(ids, found)) for found in pieces]

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """The bytes of each row of ids."""
        flat = np.frombuffer(b"".join(ids), "<u4").astype(np.int32)
        sizes = np.fromiter((len(x) // 4 for x in ids), np.int64, len(ids))
        document = np.repeat(np.arange(len(ids), dtype=np.int32), sizes)
        place = np.arange(len(flat), dtype=np.int64)
        self.con.register("ids", pa.table({"d": document, "p": place, "id": flat}))
        found = self.con.sql(DECODE).to_arrow_table()
        self.con.unregister("ids")
        decoded = [b""] * len(ids)
        for d, text in zip(found["d"].to_pylist(), found["hex"].to_pylist(), strict=True):
            decoded[d] = bytes.fromhex(text)
        return decoded


def _codec(ranks_name: str, pattern: str) -> Codec:
    """The codec of this worker process, read from the file Spark sent with the job."""
    with open(SparkFiles.get(ranks_name), "rb") as file:
        data = file.read()
    key = (hashlib.sha256(data).digest(), pattern)
    if key not in _CODECS:
        _CODECS[key] = Codec(data, pattern)
    return _CODECS[key]


def _ship(df: DataFrame, ranks_path: str) -> str:
    """Send the rank file to every executor; its name there."""
    df.sparkSession.sparkContext.addFile(ranks_path)
    return ranks_path.rstrip("/").rsplit("/", 1)[-1]


def encode(df: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """``df`` with ``ids`` (array of bigint) and ``n_tokens`` for the whole of column ``text``.

    Columns of these names in ``df`` are replaced.
    """
    name = _ship(df, ranks_path)

    @F.pandas_udf("array<bigint>")
    def ids(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            codec, found = _codec(name, pattern), []
            for part in slices(pa.array(batch, pa.string()), BYTES):
                rows = [part.bytes_of(i).decode() for i in range(len(part))]
                found += [np.frombuffer(x, "<u4").astype(np.int64) for x in codec.encode(rows)]
            yield pd.Series(found, dtype=object)

    return df.withColumn("ids", ids(F.col(text))).withColumn("n_tokens", F.size("ids"))


def token_digests(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    key: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Encode and decode every text: key, n_tokens, ids_sha256, decoded_sha256, if asked ids.

    The decoded digest is that of the bytes DuckDB decodes from the ids alone.
    """
    name = _ship(docs, ranks_path)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codec = _codec(name, pattern)
            for part in slices(batch.column(1), BYTES):
                texts = [part.bytes_of(i).decode() for i in range(len(part))]
                ids = codec.encode(texts)
                sha = lambda rows: [hashlib.sha256(x).hexdigest() for x in rows]
                columns = {
                    key: batch.column(0).slice(part.first, len(part)),
                    "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
                    "ids_sha256": pa.array(sha(ids), pa.string()),
                    "decoded_sha256": pa.array(sha(codec.decode(ids)), pa.string()),
                }
                if with_ids:
                    rows = [np.frombuffer(x, "<i4") for x in ids]
                    columns["ids"] = pa.array(rows, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(columns)

    return docs.select(F.col(key), F.col(text)).mapInArrow(
        run,
        f"`{key}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
        + ", ids array<int>" * with_ids,
    )
