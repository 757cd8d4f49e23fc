"""Near-duplicate documents by a multi-index Hamming join over b-bit MinHash signatures.

A document's set is its distinct 5-word shingles (lower-cased A-Z; the whole sequence if it has
fewer words). Its signature has 64 MinHash symbols of 16 bits. Two sets of Jaccard similarity
0.75 differ in 16 symbols on average; all pairs that differ in at most 31 are found (4.5
standard deviations above, about 2 in 100,000 pairs at exactly 0.75 differ in more, fewer
above it). Pigeonhole: of 16 chunks of four symbols one differs in at most one symbol, so each
signature is indexed under every chunk with every one of its symbols left out: 64 keys of three
symbols, and such a pair shares a key.

Equal sets are one class first, so copies cost one row. Pairs under a key are not spelled out:

1. every member of a key is held against its smallest member, by signature. Near ones are joined
   to clusters;
2. keys whose members are still in several clusters are compared in blocks of bounded size
   inside tasks, and a block returns a spanning forest of what is near, not its pairs. Now two
   documents with near signatures are always in one cluster;
3. texts meet in their cluster; tasks compare full sets through an inverted index and return a
   spanning forest of the true links, whose components are the result. First each text goes to one
   block of its cluster, and the cluster's smallest member to all of them, so a large group of near
   copies of one text becomes one component by rows in proportion to it;
4. only clusters of several blocks that still are in several components meet in all pairs of blocks,
   where what is joined already is not looked at again.

Rows that move are in proportion to documents and keys, but for step 4 and for keys of several
blocks in step 2: there each row goes to every block of its group, so these rows grow with the square
of a group that holds texts near in signature and not linked. The comparisons inside a block
are in numpy; they also grow with the square of a group of near copies that are all different, because
any two of them can be the one link between two components. A block of texts is bounded by members
and by shingles: a very long text is a block of its own.

Defined cases: ids are taken as bigint; a document without words or with null text has no shingles and is linked with
nothing; a null id is linked with nothing, its ``component_id`` is null and it is kept;
rows that repeat an id and text come out as often as they come in, and two texts under one id
count as texts of one document; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.graph import components
from skyledger.llm.prune import key_bitmap, may_have, without
from skyledger.llm.text import (
    LOWER,
    Slice,
    Words,
    constants,
    gram_hashes,
    mix,
    signed,
    slices,
)
from skyledger.session import drop_paths, write_shared

SHINGLE = 5
SYMBOLS = 64
CHUNK = 4
MAX_DIFFERENT = 31
PERCENT = 75
#: Members of a key, texts of a cluster, and their shingles, that meet at once: at most about twice
#: as many.
KEY_BLOCK = 4096
BLOCK = 1024
BLOCK_SHINGLES = 1 << 20

_XOR, _MUL = constants(SYMBOLS, 11), constants(SYMBOLS, 12)
_SET_A, _SET_B = constants(2, 13)


def shingles(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of each row, sorted by both."""
    data = LOWER[part.data]
    words = Words(part)
    hashes = words.identities(data)
    starts = words.gram_starts(SHINGLE)
    rows, found = [words.row[starts]], [gram_hashes(hashes, SHINGLE)[starts]]
    for size in range(1, SHINGLE):
        short = np.flatnonzero(words.counts == size)
        rows.append(short)
        found.append(gram_hashes(hashes, size)[words.begin[:-1][short]])
    row, value = np.concatenate(rows), np.concatenate(found)
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    first = np.ones(len(row), bool)
    first[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[first], value[first]


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch.column(1)):
            row, value = shingles(part)
            sizes = np.bincount(row, minlength=len(part))
            full = np.flatnonzero(sizes)
            starts = (np.cumsum(sizes) - sizes)[full]
            digests = np.zeros((2, len(part)), np.uint64)
            symbols = np.zeros((len(part), SYMBOLS), np.uint16)
            if len(full):
                for i, salt in enumerate((_SET_A, _SET_B)):
                    digests[i, full] = np.add.reduceat(mix(value ^ salt), starts)
                for i in range(SYMBOLS):
                    lowest = np.minimum.reduceat((value ^ _XOR[i]) * _MUL[i], starts)
                    symbols[full, i] = (mix(lowest) >> np.uint64(48)).astype(np.uint16)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(part.first, len(part)),
                    pa.array(sizes, pa.int64()),
                    pa.array(signed(digests[0])),
                    pa.array(signed(digests[1])),
                    pa.array([x.tobytes() for x in symbols], pa.binary()),
                ],
                names=["doc_id", "n_shingles", "set_a", "set_b", "signature"],
            )


def _symbols(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, np.uint16).reshape(-1, SYMBOLS)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """64 index keys for each signature: a chunk with one of its four symbols left out."""
    for batch in batches:
        symbols = _symbols(batch.column(1)).astype(np.int64)
        for chunk in range(SYMBOLS // CHUNK):
            four = symbols[:, chunk * CHUNK : (chunk + 1) * CHUNK]
            for out in range(CHUNK):
                a, b, c = np.delete(four, out, axis=1).T
                key = (chunk * CHUNK + out) << 48 | a << 32 | b << 16 | c
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), batch.column(0)], names=["key", "node"]
                )


def _whole_groups(
    batches: Iterator[pa.RecordBatch], keys: list[str]
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups of rows that lie sorted by ``keys``, and where each group begins."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        rest.append(batch)
        starts = _starts(pa.Table.from_batches(rest), keys)
        if len(starts) > 1 and sum(x.num_rows for x in rest) - starts[-1] < starts[-1]:
            table = pa.Table.from_batches(rest).combine_chunks()
            yield table.slice(0, starts[-1]), starts[:-1]
            rest = table.slice(starts[-1]).to_batches()
    if rest:
        table = pa.Table.from_batches(rest).combine_chunks()
        yield table, _starts(table, keys)


def _starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    change = np.zeros(table.num_rows, bool)
    change[:1] = True
    for key in keys:
        value = table[key].to_numpy()
        change[1:] |= value[1:] != value[:-1]
    return np.flatnonzero(change)


class _Forest:
    """Spanning forest over the places of a block, some of which are joined from the start."""

    def __init__(self, labels: np.ndarray) -> None:
        self.tree = np.unique(labels, return_inverse=True)[1]
        self.edges: list[tuple[int, int]] = []

    def apart(self, place: int, others: np.ndarray) -> np.ndarray:
        return others[self.tree[others] != self.tree[place]]

    def join(self, place: int, others: np.ndarray) -> None:
        """Add an edge to each tree that ``others`` lie in."""
        trees, first = np.unique(self.tree[others], return_index=True)
        for tree, other in zip(trees, others[first], strict=True):
            if tree != self.tree[place]:
                self.edges.append((place, int(other)))
        self.tree[np.isin(self.tree, trees)] = self.tree[place]


def _edge_batch(a: list, b: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]
    )


def _close_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (a, b, size_a, size_b, signature_a, signature_b), the near pairs."""
    for batch in batches:
        x, y = (batch.column(i).to_numpy() for i in (2, 3))
        near = 100 * np.minimum(x, y) >= PERCENT * np.maximum(x, y)
        different = _symbols(batch.column(4)) != _symbols(batch.column(5))
        near &= different.sum(axis=1) <= MAX_DIFFERENT
        yield batch.select(["a", "b"]).filter(pa.array(near))


def _close_in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning forests of the near signatures of each (key, i, j)."""
    for table, starts in _whole_groups(batches, ["key", "i", "j"]):
        node, side, label, size = (
            table[c].to_numpy() for c in ("node", "side", "label", "n_shingles")
        )
        symbols = _symbols(table["signature"])
        crossed = table["i"].to_numpy() != table["j"].to_numpy()
        a, b = [], []
        for at, to in zip(starts, [*starts[1:], table.num_rows], strict=True):
            order = at + np.argsort(size[at:to], kind="stable")
            forest, sizes = _Forest(label[order]), size[order]
            for i in range(len(order) - 1):
                last = np.searchsorted(sizes, sizes[i] * 100 // PERCENT, side="right")
                near = forest.apart(i, np.arange(i + 1, last))
                if crossed[at]:
                    near = near[side[order[near]] != side[order[i]]]
                if len(near):
                    different = (symbols[order[near]] != symbols[order[i]]).sum(axis=1)
                    near = near[different <= MAX_DIFFERENT]
                    if len(near):
                        forest.join(i, near)
            for i, j in forest.edges:
                a.append(node[order[i]])
                b.append(node[order[j]])
        yield _edge_batch(a, b)


def _links_in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning forests of the links between trees, on full sets, of each (label, i, j)."""
    for table, starts in _whole_groups(batches, ["label", "i", "j"]):
        sets: list[np.ndarray] = []
        for part in slices(table["text"]):
            row, value = shingles(part)
            sets += np.split(value, np.searchsorted(row, np.arange(1, len(part))))
        node, side, tree = (table[c].to_numpy() for c in ("node", "side", "tree"))
        crossed = table["i"].to_numpy() != table["j"].to_numpy()
        a, b = [], []
        for at, to in zip(starts, [*starts[1:], table.num_rows], strict=True):
            own = sets[at:to]
            sizes = np.array([len(x) for x in own])
            forest = _Forest(tree[at:to])
            known, code = np.unique(np.concatenate(own), return_inverse=True)
            member = np.repeat(np.arange(len(own)), sizes)
            order = np.argsort(code, kind="stable")
            owners, ends = member[order], np.searchsorted(code[order], np.arange(len(known) + 1))
            begin = np.cumsum(sizes) - sizes
            for i in range(len(own) - 1):
                mine = code[begin[i] : begin[i] + sizes[i]]
                n = ends[mine + 1] - ends[mine]
                within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                shared = owners[np.repeat(ends[mine], n) + within]
                common = np.bincount(shared, minlength=len(own))
                near = np.flatnonzero(100 * common >= PERCENT * (sizes + sizes[i] - common))
                near = forest.apart(i, near[near > i])
                if crossed[at]:
                    near = near[side[at + near] != side[at + i]]
                if len(near):
                    forest.join(i, near)
            for i, j in forest.edges:
                a.append(node[at + i])
                b.append(node[at + j])
        yield _edge_batch(a, b)


def _in_blocks(rows: DataFrame, key: str) -> DataFrame:
    """Rows dealt to the pairs (i, j) of the ``blocks`` of their group, for ``_whole_groups``."""
    dealt = (
        rows.withColumn("side", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"i": F.least("side", "other"), "j": F.greatest("side", "other")})
    )
    return _sorted_blocks(dealt.drop("other", "blocks"), key)


def _around_leaders(rows: DataFrame, key: str) -> DataFrame:
    """Rows dealt to one of the ``blocks`` of their group each, its leader (node = key) to all."""
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    own = F.array(F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    side = F.explode(F.when(F.col("node") == F.col(key), every).otherwise(own))
    dealt = rows.withColumn("side", side).withColumns({"i": F.col("side"), "j": F.col("side")})
    return _sorted_blocks(dealt.drop("blocks"), key)


def _sorted_blocks(dealt: DataFrame, key: str) -> DataFrame:
    return dealt.repartition(key, "i", "j").sortWithinPartitions(key, "i", "j", "node")


def _clusters(shared: DataFrame, reps: DataFrame) -> DataFrame:
    """(node, label): documents whose signatures are near are in one cluster."""
    measured = reps.select("node", "n_shingles", "signature")
    a, b = (
        measured.select(
            F.col("node").alias(x),
            F.col("n_shingles").alias(f"size_{x}"),
            F.col("signature").alias(f"signature_{x}"),
        )
        for x in "ab"
    )
    star = shared.where("node <> leader").selectExpr("leader AS a", "node AS b").distinct()
    near, near_path = write_shared(
        star.join(b, "b")
        .join(a, "a")
        .select("a", "b", "size_a", "size_b", "signature_a", "signature_b")
        .mapInArrow(_close_pairs, "a bigint, b bigint"),
        "near",
    )
    labels = components(near)
    named = shared.join(labels, "node", "left").select(
        "key", "node", F.coalesce("label", "node").alias("label")
    )
    mixed = (
        named.groupBy("key")
        .agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("n"))
        .where("lo < hi AND n > 2")
        .select("key", "n")
    )
    rows = named.join(mixed, "key").join(measured, "node")
    rest, rest_path = write_shared(
        _in_blocks(rows.withColumn("blocks", F.ceil(F.col("n") / KEY_BLOCK).cast("int")), "key")
        .select("key", "i", "j", "side", "node", "label", "n_shingles", "signature")
        .mapInArrow(_close_in_blocks, "a bigint, b bigint")
        .distinct(),
        "near",
    )
    if not rest.isEmpty():
        labels = components(near.union(rest))
    drop_paths(shared.sparkSession, [near_path, rest_path])
    return labels


def _linked(
    clusters: DataFrame, measured: DataFrame, texts: DataFrame
) -> tuple[DataFrame, list[str]]:
    """(node, label) of the components by full sets, and the tables that were written for them."""
    blocks = F.greatest(F.count("*") / BLOCK, F.sum("n_shingles") / BLOCK_SHINGLES)
    sizes = (
        clusters.join(measured, "node")
        .groupBy("label")
        .agg(F.ceil(blocks).cast("int").alias("blocks"))
    )

    def links(dealt: DataFrame) -> DataFrame:
        return dealt.select("label", "i", "j", "side", "node", "tree", "text").mapInArrow(
            _links_in_blocks, "a bigint, b bigint"
        )

    members = clusters.join(sizes, "label")
    own_text = F.col("node") == F.col("doc_id")
    rows = members.withColumn("tree", F.col("node")).join(texts, own_text)
    found, found_path = write_shared(links(_around_leaders(rows, "label")), "links")
    labels = components(found)
    trees = (
        members.where("blocks > 1")
        .join(labels.withColumnRenamed("label", "tree"), "node", "left")
        .withColumn("tree", F.coalesce("tree", "node"))
    )
    apart = (
        trees.groupBy("label")
        .agg(F.min("tree").alias("lo"), F.max("tree").alias("hi"))
        .where("lo < hi")
        .select("label")
    )
    rest, rest_path = write_shared(trees.join(apart, "label"), "apart")
    if rest.isEmpty():
        return labels, [found_path, rest_path]
    more, more_path = write_shared(links(_in_blocks(rest.join(texts, own_text), "label")), "links")
    return components(found.union(more)), [found_path, rest_path, more_path]


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    sets, _ = write_shared(
        docs.mapInArrow(
            _signatures,
            "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, signature binary",
        ),
        "sets",
    )
    same = ["n_shingles", "set_a", "set_b"]
    reps, reps_path = write_shared(
        sets.where("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy(*same)
        .agg(F.min("doc_id").alias("node"), F.first("signature").alias("signature")),
        "classes",
    )
    keys = reps.select("node", "signature").mapInArrow(_keys, "key bigint, node bigint")
    leaders = (
        keys.groupBy("key")
        .agg(F.min("node").alias("leader"), F.max("node").alias("last"))
        .where("leader < last")
        .drop("last")
    )
    shared, shared_path = write_shared(keys.join(leaders, "key"), "shared-keys")
    clusters = _clusters(shared, reps)
    bitmap, bitmap_path = key_bitmap(clusters, F.xxhash64("node"))
    texts = may_have(docs, F.xxhash64("doc_id"), bitmap).hint("merge")
    labels, made = _linked(clusters, reps.select("node", "n_shingles"), texts)
    drop_paths(spark, [shared_path, bitmap_path, *made])
    named = (
        reps.select("node", *same)
        .join(labels, "node", "left")
        .select(*same, F.coalesce("label", "node").alias("component"))
    )
    linked = F.expr("n_shingles > 0 AND doc_id IS NOT NULL")
    found = (
        sets.select("doc_id", *same)
        .join(named, same, "left")
        .withColumn("component_id", F.when(linked, F.col("component")).otherwise(F.col("doc_id")))
    )
    return found.select(
        "doc_id", "n_shingles", "component_id", F.expr("doc_id <=> component_id").alias("kept")
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near duplicates of a smaller id, with all their columns."""
    dropped = near_duplicates(docs).where("NOT kept").select(F.col("doc_id").alias("__gone"))
    on = F.expr("CAST(doc_id AS bigint) = __gone")
    return without(
        docs, dropped.distinct(), on, "xxhash64(CAST(doc_id AS bigint))", "xxhash64(__gone)"
    )
