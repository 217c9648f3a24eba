"""Importance resampling towards a target distribution over hashed n-grams, by segment deduplication.

Features are runs of one to three words, hashed into BUCKETS by CRC-32. A bucket's gain is the log
ratio of its share in the target to its share in the corpus, and a document's weight the sum of the
gains of its features. Gumbel noise on the weights makes the highest scores a draw without
replacement.

Newlines separate words, so they cut texts into lines without cutting a word. Lines recur (headers,
notices, copies), so the corpus is counted line by line: equal lines meet in one group, wherever they
come from, their features are counted once and multiplied by their number. N-grams across lines,
which no line has, are counted where the document is. A chunk sends a line once, so a line of a
third of all documents is one entry per chunk.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain, count, repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickweave.llm.words import chunks
from clickweave.session import materialize

BUCKETS = 10_000
SMALLEST = 20
SHARE = 5
SCALE = 1000
#: Letters and digits stay, capitals in lower case, and so do all bytes outside ASCII; the rest parts words.
_WORD_BYTES = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()


class Lines:
    """The distinct lines of a chunk of documents, their words, and where they occur.

    `words` has the words of all distinct lines, one line after the other, and `line` whose they are;
    `occurs` has the line at every place of the chunk and `occurs_doc` the document there.
    """

    def __init__(self, texts: pa.Array):
        raw = [(t or b"").split(b"\n") for t in texts.cast(pa.large_binary()).to_pylist()]
        self.n_docs = len(raw)
        flat = list(chain.from_iterable(raw))
        table: dict[bytes, int] = {}
        first = np.fromiter(map(table.setdefault, flat, count()), np.int64, len(flat))
        distinct, self.occurs = np.unique(first, return_inverse=True)
        self.occurs_doc = np.repeat(np.arange(len(raw)), [len(r) for r in raw])
        self.split = [flat[k].translate(_WORD_BYTES).split() for k in distinct.tolist()]
        self.count = np.array([len(w) for w in self.split], np.int64)
        self.start = np.cumsum(self.count) - self.count
        self.words = list(chain.from_iterable(self.split))
        self.line = np.repeat(np.arange(len(self.split)), self.count)
        self._crc = list(map(crc32, self.words))
        self._crc_space = list(map(crc32, repeat(b" "), self._crc))

    def inside(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Line and bucket of every run of one to three words within a distinct line."""
        yield self.line, _buckets(self._crc)
        two = list(map(crc32, self.words[1:], self._crc_space))
        within = self.line[1:] == self.line[:-1]
        yield self.line[1:][within], _buckets(two)[within]
        three = list(map(crc32, self.words[2:], map(crc32, repeat(b" "), two)))
        within = self.line[2:] == self.line[:-2]
        yield self.line[2:][within], _buckets(three)[within]

    def across(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Document and bucket of every run of two or three words over the end of a line."""
        sizes = self.count[self.occurs]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        occurrence = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(total) + np.repeat(self.start[self.occurs] - (ends - sizes), sizes)
        doc = self.occurs_doc[occurrence]
        for n in (2, 3):
            last = total - n + 1
            if last < 1:
                continue
            cut = (doc[n - 1 :] == doc[:last]) & (occurrence[n - 1 :] != occurrence[:last])
            at = np.flatnonzero(cut)
            crc = map(self._crc.__getitem__, place[at].tolist())
            for k in range(1, n):
                following = map(self.words.__getitem__, place[at + k].tolist())
                crc = map(crc32, following, map(crc32, repeat(b" "), crc))
            yield doc[at], _buckets(list(crc))

    def per_doc(self, of_line: np.ndarray) -> np.ndarray:
        """Sum over each document's lines of a number that each distinct line has."""
        total = np.zeros(self.n_docs, np.int64)
        np.add.at(total, self.occurs_doc, of_line[self.occurs])
        return total


def _buckets(crc: list[int]) -> np.ndarray:
    return np.array(crc, np.int64) % BUCKETS


def _histogram(docs: DataFrame) -> dict[int, int]:
    """How often each bucket occurs over all documents: at most BUCKETS entries."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        across = np.zeros(BUCKETS, np.int64)
        for piece in chunks(batches):
            lines = Lines(piece.column("text"))
            for _, buckets in lines.across():
                across += np.bincount(buckets, minlength=BUCKETS)
            times = np.bincount(lines.occurs, minlength=len(lines.split))
            full = [k for k, words in enumerate(lines.split) if words]
            yield _entries([b" ".join(lines.split[k]) for k in full], times[full], None)
        found = np.flatnonzero(across)
        yield _entries(None, across[found], found)

    def count_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            bucket, n = batch.column("bucket"), batch.column("n").to_numpy()
            known = np.asarray(bucket.is_valid())
            np.add.at(total, bucket.filter(bucket.is_valid()).to_numpy(), n[known])
            for piece in chunks(iter([batch]), text="line"):
                times = piece.column("n").to_numpy()
                lines = Lines(piece.column("line"))
                each = np.zeros(len(lines.split), np.int64)
                np.add.at(each, lines.occurs, times)
                for line, buckets in lines.inside():
                    np.add.at(total, buckets, each[line])
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found.astype(np.int32)), pa.array(total[found])], names=["bucket", "n"]
        )

    entries = docs.select("text").mapInArrow(cut, "line binary, bucket int, n bigint")
    distinct = entries.groupBy("line", "bucket").agg(F.sum("n").alias("n"))
    counted = distinct.mapInArrow(count_lines, "bucket int, n bigint")
    rows = counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    return {r["bucket"]: r["n"] for r in rows}


def _entries(
    lines: list[bytes] | None, n: np.ndarray, buckets: np.ndarray | None
) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(lines, pa.binary()) if lines is not None else pa.nulls(len(n), pa.binary()),
            pa.array(buckets.astype(np.int32)) if buckets is not None else pa.nulls(len(n), pa.int32()),
            pa.array(n.astype(np.int64)),
        ],
        names=["line", "bucket", "n"],
    )


def bucket_gains(docs: DataFrame, target: DataFrame) -> np.ndarray:
    """SCALE times the log ratio of target to corpus share of each bucket, rounded down."""
    corpus, wanted = _histogram(docs), _histogram(target)
    all_corpus, all_wanted = sum(corpus.values()), sum(wanted.values())
    return np.array(
        [
            math.floor(
                SCALE
                * math.log(
                    (wanted.get(b, 0) + 1.0)
                    * (all_corpus + BUCKETS)
                    / ((corpus.get(b, 0) + 1.0) * (all_wanted + BUCKETS))
                )
            )
            for b in range(BUCKETS)
        ],
        np.int64,
    )


def weigh(docs: DataFrame, gains: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features and weight of every row; equal lines of a chunk are weighed once."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in chunks(batches):
            lines = Lines(piece.column("text"))
            of_line = np.zeros(len(lines.split), np.int64)
            for line, buckets in lines.inside():
                np.add.at(of_line, line, gains[buckets])
            weight = lines.per_doc(of_line)
            for doc, buckets in lines.across():
                np.add.at(weight, doc, gains[buckets])
            n = lines.per_doc(lines.count)
            features = n + np.maximum(n - 1, 0) + np.maximum(n - 2, 0)
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), *map(pa.array, (n, features, weight))],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(task, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def _noise(seed: int) -> Column:
    """Gumbel noise of a document, from the hash of the seed and its id, rounded down."""
    key = F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string"))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-SCALE * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(
    docs: DataFrame, target: DataFrame, share: int = SHARE, smallest: int = SMALLEST, seed: int = 42
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every row of `docs`.

    Of the N rows with `smallest` words or more and an id, the floor(share * N / 100) of highest
    score are drawn and ranked from 1, ties to the smaller id; the others' rank is null. Null and
    empty texts have no features and weight 0. A row without id has no score and is never drawn.
    Repeated rows are weighed one by one and tie. Empty tables, of documents or target, are no error:
    the result is empty, or all buckets count as unseen in the target. Other columns are not read.

    Scores are ordered by ranges, each with an offset from the sizes of those before it.
    """
    scored = weigh(docs, bucket_gains(docs, target))
    scored = scored.withColumn("score", F.col("weight") + _noise(seed)).withColumn(
        "counts", F.col("doc_id").isNotNull() & (F.col("n_words") >= smallest)
    )
    # A table, as finding the ranges looks at the scores once more, and weighing reads all texts.
    scored = materialize(scored, "weights")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("counts").desc(), F.col("score").desc(), F.col("doc_id")]
    table = materialize(
        scored.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()),
        "scores",
    )
    sizes = dict(table.where("counts").groupBy("part").count().collect())
    drawn = share * sum(sizes.values()) // 100
    offsets, before = [], 0
    for part in sorted(sizes):
        if before < drawn:
            offsets.append((part, before))
        before += sizes[part]
    first = docs.sparkSession.createDataFrame(offsets, "part int, before bigint")
    last = max((part for part, _ in offsets), default=-1)
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    ranked = table.where(F.col("counts") & (F.col("part") <= last)).join(
        F.broadcast(first), "part"
    )
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order[1:])) + F.col("before")
    rank = F.when(place <= drawn, place).cast("bigint")
    rest = table.where(~F.col("counts") | (F.col("part") > last))
    return ranked.select(*columns, rank.alias("rank")).unionAll(
        rest.select(*columns, F.lit(None).cast("bigint").alias("rank"))
    )
