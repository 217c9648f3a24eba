"""Words of whole Arrow text columns as numpy arrays, and hashes of word sequences.

A word is a maximal run of bytes other than space and \\t \\n \\v \\f \\r, which equals
`[^\\x20\\x09-\\x0D]+` on UTF-8 text. Nothing here loops over words in Python.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import zstandard

CHUNK_BYTES = 4 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_RANDOM = np.random.Generator(np.random.PCG64(20240611))
_BYTES = _RANDOM.integers(1, 2**64, 256, np.uint64) | np.uint64(1)
_BYTES[_SPACE] = 0
_BASE = int(_RANDOM.integers(1, 2**63, dtype=np.uint64)) * 2 + 1
_PLACES = _RANDOM.integers(1, 2**64, 64, np.uint64) | np.uint64(1)
_powers = np.ones((2, 0), np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 (a bijection)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _power_tables(n: int) -> np.ndarray:
    """Powers of the hash base and of its inverse modulo 2**64; longer than asked, to grow rarely."""
    global _powers
    if _powers.shape[1] < n:
        size = max(n, CHUNK_BYTES + (1 << 16))
        bases = [_BASE % 2**64, pow(_BASE, -1, 2**64)]
        table = np.empty((2, size), np.uint64)
        for row, base in enumerate(bases):
            table[row] = base
            table[row, 0] = 1
            np.multiply.accumulate(table[row], out=table[row])
        _powers = table
    return _powers


class Words:
    """Words of one chunk of documents: `hashes` and `doc` per word, `offsets` of words per document."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        bounds = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
        data, bounds = data[bounds[0] : bounds[-1]], bounds - bounds[0]
        if lower:
            data = _LOWER[data]
        space = _SPACE[data]
        before = np.empty(len(data), bool)
        before[:1] = True
        before[1:] = space[:-1]
        before[bounds[:-1][bounds[:-1] < len(data)]] = True
        starts = np.flatnonzero(before & ~space)
        self.doc = np.searchsorted(bounds, starts, "right") - 1
        self.offsets = np.searchsorted(starts, bounds)
        power, inverse = _power_tables(len(data) + 1)
        self.hashes = np.zeros(0, np.uint64)
        if len(starts):
            sums = np.add.reduceat(_BYTES[data] * power[: len(data)], starts)
            self.hashes = mix(sums * inverse[starts])
        self.starts, self.bounds = starts, bounds

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and hashes of all runs of n words within one document."""
        size = len(self.hashes) - n + 1
        if size <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        total = np.zeros(size, np.uint64)
        for k in range(n):
            total += self.hashes[k : k + size] * _PLACES[k]
        at = np.flatnonzero(self.doc[:size] == self.doc[n - 1 :])
        return at, mix(total[at] ^ np.uint64(n))


def chunks(
    batches: Iterator[pa.RecordBatch], size: int = CHUNK_BYTES, text: str = "text"
) -> Iterator[pa.RecordBatch]:
    """Cut batches into pieces of about `size` bytes of text; a longer document is a piece by itself."""
    for batch in batches:
        sizes = np.asarray(
            pa.compute.fill_null(pa.compute.binary_length(batch.column(text)), 0), np.int64
        )
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + size, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def pack(*arrays: np.ndarray) -> bytes:
    """Compress arrays into one value; `unpack` needs their types in the same order."""
    sizes = np.array([len(a) for a in arrays], np.int64)
    body = b"".join(np.ascontiguousarray(a).tobytes() for a in (sizes, *arrays))
    return zstandard.ZstdCompressor(level=1).compress(body)


def unpack(value: bytes, *kinds: type) -> list[np.ndarray]:
    body = zstandard.ZstdDecompressor().decompress(value)
    sizes = np.frombuffer(body, np.int64, len(kinds))
    at, out = 8 * len(kinds), []
    for kind, size in zip(kinds, sizes, strict=True):
        out.append(np.frombuffer(body, kind, size, at))
        at += int(size) * np.dtype(kind).itemsize
    return out


def runs(sorted_values: np.ndarray) -> np.ndarray:
    """Where each run of equal values starts."""
    if not len(sorted_values):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]]))
