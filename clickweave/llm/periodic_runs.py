"""Periodic runs of words, found with a dictionary of basic factors.

Per power-of-two length the dictionary names all stretches of that many words, equal ones alike: a name
is the pair of names of its two halves. A stretch that occurs once in its document is left out, as
no longer one with it can repeat either, so ordinary text leaves few names after the first lengths.

The next occurrence of a name at a distance of up to its length proposes that distance as a period.
Where neighbouring positions propose the same, the occurrences form arithmetic progressions, and the
positions together are one run. Each period is looked for at the one length with length/2 < period
<= length: a run of three or more of its periods shows all its positions there (were a smaller
distance found inside it, both periods would hold on a stretch long enough for their divisor to be a
period too), so a stretch of positions is as long as the run allows and no run comes twice.

Words are compared as such, not by hashes. A chunk of documents is worked on at once; nothing is
shuffled. A document is held in memory, with about 100 bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm.words import chunks, runs

#: A run has at least this many words and this many of its periods.
LEAST_WORDS = 6
LEAST_PERIODS = 4

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
SCHEMA = (
    "doc_id bigint, n_words bigint, "
    "runs array<struct<start:bigint, length:bigint, period:bigint>>, collapsed string"
)


def basic_runs(
    words: np.ndarray, offsets: np.ndarray, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS
) -> np.ndarray:
    """Rows of document, start in it, length and period, in that order.

    `words` are numbers that stand for words, `offsets` bounds the documents; `periods` is 3 or more.
    """
    n = len(words)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    at = np.arange(n)
    key = doc * n + words
    name = np.empty(n, np.int64)
    found = []
    width = 1
    while len(at):
        order = np.argsort(key, kind="stable")
        at, key = at[order], key[order]
        same = key[1:] == key[:-1]
        step = np.diff(at)
        proposing = same & (step <= width) & (2 * step > width)
        found.append(_stretches(at[:-1][proposing], step[proposing], width, least, periods))
        repeats = np.zeros(len(at), bool)
        repeats[1:] |= same
        repeats[:-1] |= same
        new = np.ones(len(at), np.int64)
        new[1:] = ~same
        name.fill(-1)
        name[at[repeats]] = np.cumsum(new)[repeats]
        at = np.sort(at[repeats])
        at = at[at < n - width]
        at = at[(name[at + width] >= 0) & (doc[at + width] == doc[at])]
        key = name[at] * (n + 1) + name[at + width]
        width *= 2
    rows = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    owner = doc[rows[:, 0]] if len(rows) else rows[:, 0]
    rows = np.column_stack([owner, rows[:, 0] - offsets[owner], rows[:, 1:]])
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def _stretches(
    at: np.ndarray, step: np.ndarray, width: int, least: int, periods: int
) -> np.ndarray:
    """Start, length and period of the runs that neighbouring positions of one distance make up."""
    order = np.argsort(at)
    at, step = at[order], step[order]
    breaks = (np.diff(at) != 1) | (np.diff(step) != 0)
    first = np.flatnonzero(np.concatenate([[True], breaks])[: len(at)])
    last = np.append(first[1:], len(at))[: len(first)] - 1
    length = at[last] - at[first] + step[first] + width
    long = length >= np.maximum(least, periods * step[first])
    return np.column_stack([at[first], length, step[first]])[long]


def _kept(n: int, offsets: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Words that no run contains after its first period."""
    change = np.zeros(n + 1, np.int64)
    start = offsets[found[:, 0]] + found[:, 1]
    np.add.at(change, start + found[:, 3], 1)
    np.add.at(change, start + found[:, 2], -1)
    return np.cumsum(change[:n]) == 0


def _work(rows: pa.RecordBatch, least: int, periods: int) -> pa.RecordBatch:
    texts = rows.column("text").cast(pa.large_binary()).to_pylist()
    words = [(text or b"").split() for text in texts]
    offsets = np.cumsum([0, *map(len, words)])
    flat = list(chain.from_iterable(words))
    table: dict[bytes, int] = {}
    numbers = np.fromiter(map(table.setdefault, flat, count()), np.int64, len(flat))
    found = basic_runs(numbers, offsets, least, periods)
    keep = _kept(len(flat), offsets, found).tolist()
    collapsed = [
        b" ".join(compress(flat[a:b], keep[a:b])).decode()
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
    ]
    bounds = np.searchsorted(found[:, 0], np.arange(len(texts) + 1))
    fields = pa.StructArray.from_arrays([pa.array(found[:, k]) for k in (1, 2, 3)], fields=list(RUN))
    return pa.RecordBatch.from_arrays(
        [
            rows.column("doc_id"),
            pa.array(np.diff(offsets)),
            pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), fields),
            pa.array(collapsed, pa.string()),
        ],
        names=["doc_id", "n_words", "runs", "collapsed"],
    )


def find_runs(
    docs: DataFrame, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS
) -> DataFrame:
    """doc_id, n_words, the maximal runs of every row's words and the text without their repeats.

    A run is a stretch of consecutive words with smallest period q and at least max(least,
    periods * q) words that no neighbouring word extends keeping that period; they come by start,
    then period. `collapsed` has the words that no run contains after its first q, joined by one
    space. Null and empty texts have no words and no runs; a null doc_id stays null; repeated rows
    are worked on one by one; an empty table gives no rows; other columns are not read.
    """
    if periods < 3:
        raise ValueError("runs of fewer than three periods are not all found")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in chunks(batches):
            yield _work(piece, least, periods)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(task, SCHEMA)
