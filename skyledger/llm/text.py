"""Bytes, words and rolling hashes of whole texts, as numpy arrays over Arrow batches.

Texts are handled in slices of about a quarter of a megabyte, so a task's memory does not grow
with its batch; a longer text is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

SLICE_BYTES = 1 << 18

#: Words are ``[^\x20\x09-\x0D]+``: these bytes part them.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd 64-bit numbers."""
    start = np.uint64(seed) << np.uint64(32)
    return mix(np.arange(1, n + 1, dtype=np.uint64) + start) | np.uint64(1)


_BYTE = constants(256, 1)
_BASE = int(constants(1, 2)[0])
_STEPS = constants(64, 3)


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) <= n:
            size = max(n + 1, 2 * len(self.up), SLICE_BYTES + 1)
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                steps = np.full(size, np.uint64(base))
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))


_POWERS = _Powers()


class SpanHash:
    """64-bit hash of any span of a byte array from one running sum."""

    def __init__(self, data: np.ndarray) -> None:
        _POWERS.reach(len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * _POWERS.up[: len(data)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * _POWERS.down[start])

    def grams(self, size: int) -> np.ndarray:
        """Hash of each run of ``size`` bytes, by its start."""
        n = max(0, len(self.sums) - size)
        return mix((self.sums[size:] - self.sums[:n]) * _POWERS.down[:n])


class Slice:
    """Some consecutive rows of a batch: their bytes end to end and where each begins."""

    def __init__(self, first: int, data: np.ndarray, offsets: np.ndarray) -> None:
        self.first, self.data, self.offsets = first, data, offsets

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def bytes_of(self, row: int) -> bytes:
        return self.data[self.offsets[row] : self.offsets[row + 1]].tobytes()


def slices(texts: pa.Array, size: int = SLICE_BYTES) -> Iterator[Slice]:
    """The rows of a string column in runs of about ``size`` bytes; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(texts) + 1]
    if len(texts) == 0:
        return
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1
        to = min(max(to, at + 1), len(texts))
        yield Slice(at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
        at = to


class Words:
    """The words of a slice: byte spans, the row of each and the first word of each row."""

    def __init__(self, part: Slice) -> None:
        inside = ~IS_SPACE[part.data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        cuts = part.offsets[1:-1]
        cuts = cuts[cuts < len(inside)]
        first[cuts] = inside[cuts]
        last = np.zeros(len(inside), bool)
        if len(inside):
            last[:-1] = inside[:-1] & (~inside[1:] | first[1:])
            last[-1] = inside[-1]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.begin = np.searchsorted(self.start, part.offsets)
        self.counts = np.diff(self.begin)
        self.row = np.repeat(np.arange(len(part)), self.counts)

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self, data: np.ndarray) -> np.ndarray:
        return SpanHash(data)(self.start, self.end)

    def identities(self, data: np.ndarray) -> np.ndarray:
        """64 bits of the bytes of each word, where equality decides a result."""
        return word_identities(data, self.start, self.end)

    def joined(self, data: np.ndarray) -> tuple[memoryview, np.ndarray, np.ndarray]:
        """The words' bytes with one space after each, and where each word begins and ends there."""
        lengths = self.end - self.start
        n = int(lengths.sum())
        start = np.cumsum(lengths + 1) - lengths - 1
        index = np.arange(n) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        found = np.full(n + len(self), 32, np.uint8)
        found[np.repeat(start, lengths) + index] = data[np.repeat(self.start, lengths) + index]
        return memoryview(found), start, start + lengths

    def gram_starts(self, size: int) -> np.ndarray:
        """Words that begin a run of ``size`` words of one row."""
        if len(self) < size:
            return np.zeros(0, np.int64)
        n = len(self) - size + 1
        return np.flatnonzero(self.row[:n] == self.row[size - 1 :])


#: Words of more bytes are hashed one by one.
_LONG_WORD = 256


def word_identities(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of some spans: eight bytes at a time, each mixed before the next joins.

    Unlike ``SpanHash`` it is no polynomial, whose structure lets certain spans collide.
    """
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    eights = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    length = end - start
    total = mix(length.astype(np.uint64) + np.uint64(_BASE))
    live, at = np.flatnonzero(length <= _LONG_WORD), 0
    live = live[length[live] > 0]
    while len(live):
        left = np.minimum(length[live] - at, 8).astype(np.uint64)
        taken = eights[start[live] + at] & (~np.uint64(0) >> (np.uint64(64) - np.uint64(8) * left))
        total[live] = mix((total[live] ^ taken) * _STEPS[0] + _STEPS[1])
        at += 8
        live = live[length[live] > at]
    for i in np.flatnonzero(length > _LONG_WORD):
        total[i] = xxhash.xxh3_64_intdigest(data[start[i] : end[i]].tobytes())
    return total


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` word hashes, by its first word (over the whole slice)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(size):
        total += words[i : i + n] * _STEPS[i % len(_STEPS)] * np.uint64(2 * (i // len(_STEPS)) + 1)
    return mix(total)


def signed(x: np.ndarray) -> np.ndarray:
    """The same bits as Spark's bigint."""
    return x.view(np.int64)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours, by the first, from minima within blocks."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    blocks = -(-len(values) // width)
    filled = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    filled[: len(values)] = values
    square = filled.reshape(blocks, width)
    ahead = np.minimum.accumulate(square, axis=1).ravel()
    behind = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])
