"""Document fingerprints: digests of improbable byte windows in chained Bloom filters.

Every WINDOW bytes of a text have an entropy, in CLASSES steps. How often each step occurs over all
documents ranks it: the rarer, the more telling. Among any FEATURES windows that start at
neighbouring bytes the one of lowest rank gains a point, the first of equal ones; windows of POINTS
points and more are the text's features. Their hashes set HASHES bits each in a Bloom filter of BITS
bits, and after FULL features a new filter follows, so a digest grows with its text and neither
fills up nor is cut.

Two filters are as like as the bits they share beyond what chance gives, as a part of the most they
could share beyond it (nothing, where that is within what chance varies by); two digests as like as the filters of the one with fewer features find
their best match in the other, weighted by features.

Work is done in blocks of BLOCK bytes, whatever the length of a text; a text itself is held in memory.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm.words import chunks, mix

WINDOW = 32
FEATURES = 32
POINTS = 8
BITS = 2048
HASHES = 5
FULL = 160
CLASSES = 1000
#: Shared bits within so many deviations of what chance gives count as none.
NOISE = 3.0
BLOCK = 1 << 19

#: c * log2(c) for c equal bytes of a window, as whole numbers, so that sums never drift.
_UNIT = 1 << 20
_PART = np.array([0] + [round(c * np.log2(c) * _UNIT) for c in range(1, WINDOW + 1)], np.int64)
_STEP = np.diff(_PART)
_MOST = int(_PART[WINDOW])
_ODD = np.random.Generator(np.random.PCG64(13)).integers(1, 2**64, WINDOW // 8, np.uint64)
_ODD |= np.uint64(1)
_NEVER = np.uint16(0xFFFF)


class Digest(NamedTuple):
    """Features per filter, and the filters as rows of 64-bit words."""

    counts: np.ndarray
    filters: np.ndarray

    def __str__(self) -> str:
        """`features:filter in base 64` of each filter, comma-joined; empty without features."""
        parts = zip(self.counts.tolist(), self.filters, strict=True)
        return ",".join(f"{n}:{base64.b64encode(row.tobytes()).decode()}" for n, row in parts)


def entropy_classes(data: np.ndarray) -> np.ndarray:
    """Class of the entropy of every window of `data`: one per start, 0 for a single repeated byte.

    From one start to the next a byte comes and a byte goes, and only their two counts change. How
    often a byte occurs in the WINDOW - 1 bytes before or after its place comes from the places of
    equal bytes in order.
    """
    n = len(data) - WINDOW + 1
    if n < 1:
        return np.zeros(0, np.uint16)
    order = np.argsort(data, kind="stable").astype(np.int32)
    key = (data[order].astype(np.int32) << 23) | order  # a block has fewer than 2**23 bytes
    low = np.searchsorted(key, key - np.int32(WINDOW - 1)).astype(np.int32)
    high = np.cumsum(np.bincount(low, minlength=len(data)), dtype=np.int32)
    place = np.arange(len(data), dtype=np.int32)
    before, after = np.empty((2, len(data)), np.uint8)
    before[order] = place - low
    after[order] = high - 1 - place
    total = np.empty(n, np.int64)
    total[0] = _PART[np.bincount(data[:WINDOW], minlength=256)].sum()
    total[1:] = _STEP[before[WINDOW:]]
    total[1:] -= _STEP[after[: n - 1]]
    np.cumsum(total, out=total)
    return ((_MOST - total) * CLASSES // _MOST).astype(np.uint16)


def _blocks(n: int) -> Iterator[tuple[int, int]]:
    for start in range(0, n, BLOCK):
        yield start, min(n, start + BLOCK)


def window_ranks(data: np.ndarray, bounds: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Rank of the window at every byte of texts that follow each other; _NEVER where none fits."""
    out = np.full(len(data), _NEVER)
    for start, stop in _blocks(len(data)):
        classes = entropy_classes(data[start : stop + WINDOW - 1])
        out[start : start + len(classes)] = ranks[classes]
    for end in bounds[1:].tolist():
        out[max(0, end - WINDOW + 1) : end] = _NEVER
    return out


def popularity(rank: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Points of the window at every byte: the stretches of FEATURES windows in which it is first."""
    points = np.zeros(len(rank), np.uint8)
    whole = np.zeros(len(rank), bool)
    for begin, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        whole[begin : max(begin, end - WINDOW - FEATURES + 2)] = True
    for start, stop in _blocks(len(rank)):
        best = rank[start : stop + FEATURES - 1].astype(np.int64) << 32
        best |= np.arange(len(best))
        for k in range(FEATURES.bit_length() - 1):
            best = np.minimum(best[: -(1 << k)], best[1 << k :]) if len(best) > 1 << k else best[:0]
        winners = best[whole[start : start + len(best)]] & ((1 << 32) - 1)
        scored = np.bincount(winners) if len(winners) else np.zeros(0, np.int64)
        points[start : start + len(scored)] += scored.astype(np.uint8)
    return points


def _hashes(windows: np.ndarray, length: np.ndarray) -> np.ndarray:
    """64-bit hashes of rows of WINDOW bytes, of which the first `length` count."""
    parts = mix(windows.view("<u8") ^ _ODD) * _ODD
    return mix(parts.sum(axis=1, dtype=np.uint64) + length.astype(np.uint64))


def _digest(hashes: np.ndarray) -> Digest:
    first = np.sort(np.unique(hashes, return_index=True)[1])
    distinct = hashes[first]
    n = -(-len(distinct) // FULL)
    bits = np.zeros((n, BITS), bool)
    owner = np.arange(len(distinct)) // FULL
    for k in range(HASHES):
        bits[owner, ((distinct >> np.uint64(11 * k)) % np.uint64(BITS)).astype(np.int64)] = True
    return Digest(np.bincount(owner, minlength=n), np.packbits(bits, axis=1).view(np.uint64))


def digests(texts: list[bytes], ranks: np.ndarray) -> list[Digest]:
    """Digests of texts by the given ranks of the classes.

    Where no window has POINTS points, all with the most points among the text's are features; a text
    of fewer than WINDOW + FEATURES - 1 bytes has the first of its lowest rank, one of fewer than
    WINDOW bytes itself as a whole, and an empty one none.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    data = np.frombuffer(b"".join(texts) + bytes(WINDOW), np.uint8)
    rank = window_ranks(data[: bounds[-1]], bounds, ranks)
    points = popularity(rank, bounds)
    chosen = points >= POINTS
    some = np.add.reduceat(np.append(chosen, False), bounds[:-1], dtype=np.int64) if len(texts) else []
    for k in np.flatnonzero((np.asarray(some) == 0) | (sizes == 0)).tolist():
        begin, end = int(bounds[k]), int(bounds[k + 1])
        if end - begin >= WINDOW:
            most = points[begin:end]
            single = not most.any()
            pick = [np.argmin(rank[begin:end])] if single else np.flatnonzero(most == most.max())
            chosen[begin + np.asarray(pick)] = True
    at = np.flatnonzero(chosen)
    hashed = _hashes(
        np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, WINDOW)[at]),
        np.full(len(at), WINDOW),
    )
    cut = np.searchsorted(at, bounds)
    out = []
    for k, text in enumerate(texts):
        own = hashed[cut[k] : cut[k + 1]]
        if 0 < len(text) < WINDOW:
            padded = np.frombuffer(text.ljust(WINDOW, b"\0"), np.uint8)[None]
            own = _hashes(padded.copy(), np.array([len(text)]))
        out.append(_digest(own))
    return out


def likeness(one: Digest, other: Digest) -> float:
    """From 0 to 1; equal digests give 1, also two empty ones; an empty and another one 0."""
    if not len(one.counts) or not len(other.counts):
        return float(len(one.counts) == len(other.counts))
    if one.counts.sum() > other.counts.sum():
        one, other = other, one
    size = np.bitwise_count(other.filters).sum(axis=1, dtype=np.int64)
    best = np.empty(len(one.counts))
    for k, row in enumerate(one.filters):
        own = int(np.bitwise_count(row).sum(dtype=np.int64))
        shared = np.bitwise_count(other.filters & row).sum(axis=1, dtype=np.int64)
        chance = own * size / BITS
        beyond = shared - chance
        beyond[beyond <= NOISE * np.sqrt(chance)] = 0
        best[k] = (beyond / (np.minimum(own, size) - chance)).max()
    return float(np.average(np.clip(best, 0, 1), weights=one.counts))


def entropy_ranks(docs: DataFrame) -> np.ndarray:
    """Rank of each class by its number of windows over all documents, the rarest first.

    Ties go to the lower class; windows of a single byte come last, whatever their number.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES + 1, np.int64)
        ranks = np.arange(CLASSES + 1, dtype=np.uint16)
        for piece in chunks(batches, BLOCK):
            texts = _bytes(piece.column("text"))
            bounds = np.cumsum([0, *map(len, texts)])
            classes = window_ranks(np.frombuffer(b"".join(texts), np.uint8), bounds, ranks)
            total += np.bincount(classes[classes != _NEVER], minlength=CLASSES + 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(CLASSES + 1, dtype=np.int32)), pa.array(total)], names=["class", "n"]
        )

    counted = docs.select("text").mapInArrow(task, "class int, n bigint")
    n = np.zeros(CLASSES + 1, np.int64)
    for row in counted.groupBy("class").agg(F.sum("n").alias("n")).collect():
        n[row["class"]] = row["n"]
    n[0] = np.iinfo(np.int64).max
    ranks = np.empty(CLASSES + 1, np.uint16)
    ranks[np.argsort(n, kind="stable")] = np.arange(CLASSES + 1)
    return ranks


def _bytes(texts: pa.Array) -> list[bytes]:
    return [t or b"" for t in texts.cast(pa.large_binary()).to_pylist()]


def fingerprints(docs: DataFrame, ranks: np.ndarray) -> DataFrame:
    """doc_id and fingerprint of every row, by `ranks` of entropy_ranks.

    Null text counts as empty and has the empty fingerprint; a null doc_id stays null; equal texts
    have equal fingerprints; repeated rows are worked on one by one; other columns are not read.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in chunks(batches, BLOCK):
            found = digests(_bytes(piece.column("text")), ranks)
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array([str(d) for d in found], pa.string())],
                names=["doc_id", "fingerprint"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(task, "doc_id bigint, fingerprint string")


def spliced(text: str, following: str) -> str:
    """The last half of the text's code points replaced by as many first ones of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


class _Order(NamedTuple):
    """Ranges of ids, and for each the first row of the range that follows in descending order."""

    bounds: np.ndarray
    n_parts: int
    following: dict[int, int]


def _ranges(docs: DataFrame) -> _Order:
    """Cut the ids into as many ranges as there are shuffle partitions, by quantiles of all ids.

    What the driver gets is one number per range.
    """
    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id")).where("doc_id IS NOT NULL")
    n_parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [k / n_parts for k in range(1, n_parts)]
    found = ids.approxQuantile("doc_id", shares, max(1e-4, 0.1 / n_parts)) if shares else []
    bounds = np.unique(np.array(found, np.int64))

    def largest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most: dict[int, int] = {}
        for batch in batches:
            values = np.sort(batch.column("doc_id").to_numpy())
            part = np.searchsorted(bounds, values, "right")
            for p, value in zip(part.tolist(), values.tolist(), strict=True):
                most[p] = max(value, most.get(p, value))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(most), pa.int32()), pa.array(list(most.values()), pa.int64())],
            names=["part", "doc_id"],
        )

    tops = ids.mapInArrow(largest, "part int, doc_id bigint").groupBy("part").agg(F.max("doc_id"))
    top = sorted(map(tuple, tops.collect()))
    lower = [top[-1], *top[:-1]] if top else []
    following = {part: first for (part, _), (_, first) in zip(top, lower, strict=True)}
    return _Order(bounds, len(bounds) + 1, following)


def _in_order(docs: DataFrame) -> DataFrame:
    """Ranges of rows by descending id, each with a copy of the row that follows its last one.

    Texts move once, compressed. Rows of equal id go by the hash of their text.
    """
    order = _ranges(docs)
    rows = docs.where("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text"
    )
    firsts = rows.where(F.col("doc_id").isin(list(set(order.following.values()))))
    firsts = firsts.groupBy("doc_id").agg(
        F.min("text_key").alias("text_key"), F.min_by("text", "text_key").alias("text")
    )
    places: dict[int, list[int]] = {}
    for part, doc in order.following.items():
        places.setdefault(doc, []).append(part)

    def dealt(parts: Callable[[int], list[int]] | None):
        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            packer = zstandard.ZstdCompressor(level=3)
            for batch in chunks(batches, BLOCK):
                ids = batch.column("doc_id").to_numpy()
                if parts is None:
                    part, at = np.searchsorted(order.bounds, ids, "right"), np.arange(len(ids))
                else:
                    targets = [parts(d) for d in ids.tolist()]
                    part = np.array([p for t in targets for p in t], np.int64)
                    at = np.repeat(np.arange(len(ids)), [len(t) for t in targets])
                bodies = [packer.compress(t) for t in _bytes(batch.column("text"))]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(part.astype(np.int32)),
                        pa.array(np.full(len(at), parts is not None)),
                        pa.array(ids[at]),
                        batch.column("text_key").take(pa.array(at)),
                        pa.array([bodies[k] for k in at.tolist()], pa.binary()),
                    ],
                    names=["part", "copy", "doc_id", "text_key", "body"],
                )

        return task

    schema = "part int, copy boolean, doc_id bigint, text_key bigint, body binary"
    moved = rows.mapInArrow(dealt(None), schema).unionAll(
        firsts.mapInArrow(dealt(lambda doc: places[doc]), schema)
    )
    return moved.repartitionById(order.n_parts, F.col("part")).sortWithinPartitions(
        "part", "copy", F.desc("doc_id"), "text_key"
    )


def compare_spliced(docs: DataFrame, ranks: np.ndarray) -> DataFrame:
    """Fingerprints of each text, of its edited text, and how like they and the next one's are.

    The next document is the one of next smaller doc_id, after the smallest the largest; rows of
    equal id follow by the hash of their text. The edited text is `spliced` from both. Null text
    counts as empty. A row without id has no next one: its edited columns and likenesses are null.
    A single row is its own next. An empty table gives no rows; other columns are not read.
    """
    unpacked = _in_order(docs)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bool, int, bytes]]:
        opener = zstandard.ZstdDecompressor()
        for batch in batches:
            for part, copy, doc, body in zip(
                *(batch.column(c).to_pylist() for c in ("part", "copy", "doc_id", "body")), strict=True
            ):
                yield part, copy, doc, opener.decompress(body)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, bool, int, bytes]] = []
        size = 0
        for row in rows(batches):
            held.append(row)
            size += len(row[3])
            if size >= BLOCK:
                yield _compared(held, ranks)
                held, size = held[-1:], len(row[3])
        yield _compared(held, ranks)

    schema = (
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    chained = unpacked.mapInArrow(task, schema)
    single = docs.where("doc_id IS NULL")

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in chunks(batches, BLOCK):
            found = digests(_bytes(piece.column("text")), ranks)
            n = pc.fill_null(pc.utf8_length(piece.column("text")), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [n, pa.array([str(d) for d in found], pa.string())], names=["n_chars", "fingerprint"]
            )

    alone = single.select("text").mapInArrow(plain, "n_chars bigint, fingerprint string")
    empty = F.lit(None)
    return chained.unionAll(
        alone.select(
            empty.cast("bigint"),
            "n_chars",
            empty.cast("string"),
            "fingerprint",
            empty.cast("string"),
            empty.cast("double"),
            empty.cast("double"),
        )
    )


def _compared(held: list[tuple[int, bool, int, bytes]], ranks: np.ndarray) -> pa.RecordBatch:
    """The comparison of every row but the last with the one after it."""
    texts = [body.decode("utf-8", "surrogateescape") for *_, body in held]
    edited = [
        spliced(text, following).encode("utf-8", "surrogateescape")
        for text, following in zip(texts, texts[1:], strict=False)
    ]
    own, changed = digests([row[3] for row in held], ranks), digests(edited, ranks)
    out = []
    for k, new in enumerate(changed):
        part, copy, doc, _ = held[k]
        if copy:  # the copy that ends a range; the next range starts after it
            continue
        if held[k + 1][0] != part:
            raise RuntimeError("a range of ids lacks the row after its last; give a stable input")
        out.append(
            (
                doc,
                len(texts[k]),
                hashlib.sha256(edited[k]).hexdigest(),
                str(own[k]),
                str(new),
                likeness(own[k], new),
                likeness(own[k], own[k + 1]),
            )
        )
    columns = list(zip(*out, strict=True)) if out else [[]] * 7
    kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
        names=[
            "doc_id",
            "n_chars",
            "edited_sha256",
            "fingerprint",
            "edited_fingerprint",
            "near_edited",
            "near_next",
        ],
    )
