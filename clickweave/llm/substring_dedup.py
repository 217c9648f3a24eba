"""Substring deduplication by relative Lempel-Ziv parsing.

Every run of WINDOW words is indexed under its hash with the earliest document that has it; the
index is dealt into blocks by hash. A document is factored against it greedily, from its first word
on: where a window has an earlier source, the document's and the source's words are the same from
there on for as long as the windows that name this source at this distance meet or overlap, whatever
other sources the windows between them name. That is the factor. The next one is sought from the
first window that runs past its end, so nothing is lost at factor boundaries. Factors are the duplicate
spans; none lies inside the one before it.

A window names one source, the earliest document at its first place there. So a factor is as long
as its source allows, unless WINDOW windows in a row name others: there it is cut in two, with the
others' factors between.

A chunk settles its own repeats: only the earliest document of the chunk asks the index about a
window, so a passage shared by very many documents sends one entry per chunk.

Windows are compared by 64-bit hashes: among n windows about n**2 / 2**65 pairs agree by chance.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm import exchange
from clickweave.llm.words import Words, pack, runs, unpack

WINDOW = 13
FACTOR = pa.struct(
    [
        ("start", pa.int32()),
        ("length", pa.int32()),
        ("source_doc", pa.int64()),
        ("source_start", pa.int32()),
    ]
)
FACTORS = (
    "doc_id bigint, text_key bigint, factors "
    "array<struct<start:int, length:int, source_doc:bigint, source_start:int>>"
)


def _ask(n_parts: int, window: int):
    def work(chunk: int, rows: pa.RecordBatch) -> Iterator[exchange.Row]:
        rows = rows.take(pc.sort_indices(rows, [("doc_id", "ascending"), ("text_key", "ascending")]))
        ids = rows.column("doc_id").to_numpy()
        words = Words(rows.column("text"))
        at, hashes = words.windows(window)
        local = exchange.repeated(hashes)
        local = local[np.lexsort((local, hashes[local]))]
        starts = runs(hashes[local])
        first = np.repeat(local[starts], np.diff([*starts, len(local)]))
        later = ids[words.doc[at[local]]] > ids[words.doc[at[first]]]
        asking = np.ones(len(at), bool)
        asking[local[later]] = False
        found, source = at[local[later]], at[first[later]]
        order = np.argsort(found)
        found, source = found[order], source[order]
        keys = rows.column("text_key").to_numpy()
        offsets = words.offsets.astype(np.uint32)
        body = pack(ids, keys, offsets, found.astype(np.uint32), source.astype(np.uint32))
        yield chunk % n_parts, chunk, 1, body
        open_at, open_hashes = at[asking], hashes[asking]
        for part, picked in exchange.by_part(open_hashes, n_parts):
            place = open_at[picked]
            docs, counts = np.unique(words.doc[place], return_counts=True)
            body = pack(
                open_hashes[picked],
                np.diff(place, prepend=0).astype(np.uint32),
                np.diff(ids[docs], prepend=0),
                counts.astype(np.uint32),
                offsets[docs],
            )
            yield part, chunk, 0, body

    return work


def _look_up(rows: list[exchange.Row]) -> Iterator[exchange.Row]:
    """Earliest document and place of every window that some later document has too."""
    pieces = [unpack(r[3], np.uint64, np.uint32, np.int64, np.uint32, np.uint32) for r in rows]
    if not pieces:
        return
    hashes = np.concatenate([p[0] for p in pieces])
    bounds = np.cumsum([0, *(len(p[0]) for p in pieces)])
    same = exchange.repeated(hashes)
    sender = np.searchsorted(bounds, same, "right") - 1
    docs, inside, place = (np.empty(len(same), np.int64) for _ in range(3))
    for k, order in _groups(sender):
        _, steps, id_steps, counts, offsets = pieces[k]
        local = same[order] - bounds[k]
        owner = np.searchsorted(np.cumsum(counts), local, "right")
        place[order] = np.cumsum(steps, dtype=np.int64)[local]
        docs[order] = np.cumsum(id_steps)[owner]
        inside[order] = place[order] - offsets[owner]
    order = np.lexsort((inside, docs, hashes[same]))
    starts = runs(hashes[same][order])
    first = np.repeat(order[starts], np.diff([*starts, len(order)]))
    later = docs[order] > docs[first]
    asker, source = order[later], first[later]
    for k, picked in _groups(sender[asker]):
        picked = picked[np.argsort(place[asker[picked]])]
        body = pack(
            place[asker[picked]].astype(np.uint32),
            docs[source[picked]],
            inside[source[picked]].astype(np.uint32),
        )
        yield 0, rows[k][1], 0, body


def _groups(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(keys, kind="stable")
    bounds = [*runs(keys[order]), len(keys)]
    for start, stop in itertools.pairwise(bounds):
        yield int(keys[order[start]]), order[start:stop]


def grow(
    place: np.ndarray, own_doc: np.ndarray, docs: np.ndarray, inside: np.ndarray, window: int
) -> list[np.ndarray]:
    """Starts, ends, source documents and source starts of the factors, in order of their starts.

    The windows at `place` of documents `own_doc` also start at word `inside` of documents `docs`.
    Windows of one source at one distance that meet or overlap are a stretch of equal words, and
    a stretch that ends no later than one that starts before it is no factor.
    """
    if not len(place):
        return [np.zeros(0, np.int64)] * 4
    distance = place - inside
    order = np.lexsort((place, distance, docs, own_doc))
    place, own_doc, docs, distance = (x[order] for x in (place, own_doc, docs, distance))
    apart = (np.diff(own_doc) != 0) | (np.diff(docs) != 0) | (np.diff(distance) != 0)
    first = np.flatnonzero(np.concatenate([[True], apart | (np.diff(place) > window)]))
    last = np.concatenate([first[1:], [len(place)]]) - 1
    starts, ends = place[first], place[last] + window
    source_docs, source_starts = docs[first], starts - distance[first]
    # No two documents share a place, so a stretch never reaches into the document after.
    order = np.lexsort((-ends, starts))
    reach = np.maximum.accumulate(np.concatenate([[-1], ends[order][:-1]]))
    order = order[ends[order] > reach]
    return [x[order] for x in (starts, ends, source_docs, source_starts)]


def _factor(window: int):
    def work(own: bytes, replies: list[bytes]) -> pa.RecordBatch:
        kinds = (np.int64, np.int64, np.uint32, np.uint32, np.uint32)
        ids, keys, offsets, found, source = unpack(own, *kinds)
        offsets = offsets.astype(np.int64)
        source = source.astype(np.int64)
        owner = np.searchsorted(offsets, source, "right") - 1
        answers = [unpack(r, np.uint32, np.int64, np.uint32) for r in replies]
        place = np.concatenate([found, *(a[0] for a in answers)]).astype(np.int64)
        docs = np.concatenate([ids[owner], *(a[1] for a in answers)])
        inside = np.concatenate([source - offsets[owner], *(a[2] for a in answers)]).astype(np.int64)
        own_doc = np.searchsorted(offsets, place, "right") - 1
        starts, ends, source_docs, source_starts = grow(place, own_doc, docs, inside, window)
        doc = np.searchsorted(offsets, starts, "right") - 1
        touched = runs(doc)
        factors = pa.StructArray.from_arrays(
            [
                pa.array((starts - offsets[doc]).astype(np.int32)),
                pa.array((ends - starts).astype(np.int32)),
                pa.array(source_docs.astype(np.int64)),
                pa.array(source_starts.astype(np.int32)),
            ],
            fields=list(FACTOR),
        )
        lists = pa.ListArray.from_arrays(
            pa.array([*touched, len(doc)] if len(doc) else [0], pa.int32()), factors
        )
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[doc[touched]]), pa.array(keys[doc[touched]]), lists],
            names=["doc_id", "text_key", "factors"],
        )

    return work


def duplicate_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Factors of `window` words or more that also start in a document with a smaller doc_id.

    One row per document and text that has any; word positions count from 0. Rows without doc_id
    are neither parsed nor sources.
    """
    rows = docs.where("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("text_key")
    )
    n_parts = exchange.parts_of(rows)
    sent = exchange.send(rows, _ask(n_parts, window), n_parts)
    return exchange.collect(exchange.answer(sent, _look_up), _factor(window), FACTORS)


def remove_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and kept_text (kept words joined by one space) of every row.

    Null text has no words. Equal ids are no earlier documents for each other, so repeated rows are
    treated alike. Rows without doc_id keep all words. Other columns are not read.
    """
    spans = duplicate_spans(docs, window)
    spans = spans.groupBy("doc_id", "text_key").agg(F.max("factors").alias("factors"))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("text_key")
    ).join(spans, ["doc_id", "text_key"], "left")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, kept = [], [], []
            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            for text, factors in zip(texts, batch.column("factors").to_pylist(), strict=True):
                words = (text or b"").split()
                keep = np.ones(len(words), bool)
                for f in factors or []:
                    keep[f["start"] : f["start"] + f["length"]] = False
                counts.append(len(words))
                removed.append(len(words) - int(keep.sum()))
                kept.append(b" ".join(itertools.compress(words, keep.tolist())).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *map(pa.array, (counts, removed)), pa.array(kept, pa.string())],
                schema=pa.schema(
                    [
                        ("doc_id", pa.int64()),
                        ("n_words", pa.int64()),
                        ("n_removed", pa.int64()),
                        ("kept_text", pa.string()),
                    ]
                ),
            )

    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_text string"
    return rows.select("doc_id", "text", "factors").mapInArrow(work, schema)
