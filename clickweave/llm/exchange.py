"""Packed exchange between map and reduce tasks.

A map task handles a chunk of documents at a time. Per chunk and target part it sends one row with a
packed value, so a shuffle moves few rows and compact bytes. `chunk` names the sender for replies.
There is a part for every PART_BYTES of input, and a task answers its parts one after the other, so
what it holds at once does not grow with the input.
Chunks follow the row order of their input, which must be the same when a lost task runs again, as
it is for files.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.llm.words import CHUNK_BYTES, chunks

SCHEMA = "part int, chunk bigint, kind int, body binary"
ARROW = pa.schema(
    [("part", pa.int32()), ("chunk", pa.int64()), ("kind", pa.int32()), ("body", pa.binary())]
)
Row = tuple[int, int, int, bytes]
#: Input behind one part: of text, about six million words, whose hashes and places are held at once.
PART_BYTES = 32 << 20


def parts(spark: SparkSession) -> int:
    """Partitions of a shuffle."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def parts_of(rows: DataFrame, column: str = "text", part_bytes: int | None = None) -> int:
    """Parts for all bytes of `column`, and at least one for each partition of a shuffle."""
    size = rows.agg(F.sum(F.octet_length(column))).first()[0] or 0
    return max(parts(rows.sparkSession), -(-size // (part_bytes or PART_BYTES)))


def _batch(rows: list[Row]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, ARROW, strict=True)], schema=ARROW
    )


def mapped(
    docs: DataFrame,
    work: Callable[[int, pa.RecordBatch], Iterator[Row]],
    chunk_bytes: int = CHUNK_BYTES,
    column: str = "text",
) -> DataFrame:
    """Run `work(chunk id, rows)` over chunks of `docs`."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        for k, piece in enumerate(chunks(batches, chunk_bytes, column)):
            yield _batch(list(work(base + k, piece)))

    return docs.mapInArrow(task, SCHEMA)


def send(
    docs: DataFrame,
    work: Callable[[int, pa.RecordBatch], Iterator[Row]],
    n_parts: int,
    chunk_bytes: int = CHUNK_BYTES,
    column: str = "text",
) -> DataFrame:
    """Deal the rows that `work` gives for each chunk out by part, `n_parts` in all."""
    rows = mapped(docs, work, chunk_bytes, column)
    tasks = parts(docs.sparkSession)
    if n_parts <= tasks:  # a part is a partition
        return rows.repartitionById(tasks, F.col("part"))
    dealt = rows.repartitionById(tasks, F.pmod("part", F.lit(tasks)))
    return dealt.sortWithinPartitions("part")


def answer(
    sent: DataFrame,
    work: Callable[[list[Row]], Iterator[Row]],
    own: DataFrame | None = None,
    merge: bool = False,
) -> DataFrame:
    """Run `work` over all rows of each part and bring its replies back together by chunk.

    Rows of a kind other than 0 are passed on; `own` has more of them, which need no part. With
    `merge` adaptive execution may put small partitions of replies together, so that a table written
    from them has fewer files.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine: list[Row] = []
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            if other := [r for r in rows if r[2] != 0]:
                yield _batch(other)
            for row in rows:
                if row[2] != 0:
                    continue
                if mine and row[0] != mine[0][0]:
                    yield from (_batch([reply]) for reply in work(mine))
                    mine = []
                mine.append(row)
        yield from (_batch([reply]) for reply in work(mine))

    spark = sent.sparkSession
    replies = sent.mapInArrow(task, SCHEMA)
    if own is not None:
        replies = replies.unionAll(own)
    keys = ["chunk"] if merge else [parts(spark), "chunk"]
    replies = replies.repartition(*keys)
    return replies.sortWithinPartitions("chunk", F.desc("kind"))


def collect(
    replies: DataFrame, work: Callable[[bytes, list[bytes]], pa.RecordBatch], schema: str
) -> DataFrame:
    """Run `work(own row, replies)` for every chunk, and for each of equal chunks."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in grouped(batches, "chunk"):
            kinds, bodies = rows["kind"], rows["body"]
            own = [b for k, b in zip(kinds, bodies, strict=True) if k != 0]
            if not own:
                raise RuntimeError("chunks differ between runs of a task; give a stable input")
            replies = [b for k, b in zip(kinds, bodies, strict=True) if k == 0]
            for body in own:
                yield work(body, replies)

    return replies.mapInArrow(task, schema)


def grouped(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[dict[str, list]]:
    """Columns of each run of rows with equal keys, over batch borders."""
    current: dict[str, list] | None = None
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = batch.to_pydict()
        named = list(zip(*(columns[k] for k in keys), strict=True))
        starts = [i for i in range(len(named)) if i == 0 or named[i] != named[i - 1]]
        for start, stop in zip(starts, [*starts[1:], len(named)], strict=True):
            piece = {name: values[start:stop] for name, values in columns.items()}
            if current is not None and named[start] == last:
                for name, values in piece.items():
                    current[name] += values
            else:
                if current is not None:
                    yield current
                current, last = piece, named[start]
    if current is not None:
        yield current


def by_part(hashes: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each part that has entries, with their positions in order."""
    part = (hashes >> np.uint64(33)) % np.uint64(n)
    small = part.astype(np.uint16 if n < 1 << 16 else np.uint32)
    order = np.argsort(small, kind="stable")
    bounds = np.searchsorted(small[order], np.arange(n + 1))
    for p in np.flatnonzero(np.diff(bounds)):
        yield int(p), order[bounds[p] : bounds[p + 1]]


def repeated(values: np.ndarray) -> np.ndarray:
    """Positions of values that occur twice or more, ordered by value."""
    order = np.argsort(values)
    same = values[order][1:] == values[order][:-1]
    twice = np.zeros(len(values), bool)
    twice[1:] |= same
    twice[:-1] |= same
    return order[twice]
