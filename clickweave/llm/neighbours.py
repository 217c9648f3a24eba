"""Nearest neighbours by inner product with collision-counting hashing.

Largest inner products become nearest points once every vector gets one more coordinate that makes
all norms equal and queries get a zero there. PROJECTIONS random lines each hold a block's points in
a sorted array. Around a query's own place on every line a window is opened; a point in at least
THRESHOLD of the windows is a candidate, and its exact inner product is computed. Virtual rehashing
widens all windows by GROWTH until enough points are candidates, at the latest when the windows hold
the whole block; only the places that a window newly reaches are read and counted, each once. A
query starts from the radius that the one before it needed.

Points are dealt into blocks by hash, and queries visit every block in batches; the best of each
block are merged. Copies of a point share all windows, so a hot vector only adds candidates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickweave.llm import exchange

PROJECTIONS = 64
THRESHOLD = 45
#: Half-width of the first windows and its growth per round, in standard deviations of a line.
FIRST, GROWTH = 0.1, 1.12
#: Candidates to verify before a block is left: this many and this share of the block. Vectors
#: without any structure (64 independent coordinates) need this much for a recall above 0.9.
ENOUGH, SHARE = 400, 0.2
BLOCK_ROWS = 8192
QUERY_ROWS = 4096
SEED = 20240611


def usable(vector: Column) -> Column:
    """Neither null nor empty nor zero, and all components finite."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _lines(width: int) -> np.ndarray:
    """PROJECTIONS directions from as many random orthonormal bases as needed, one per column."""
    random = np.random.Generator(np.random.PCG64(SEED))
    bases = [np.linalg.qr(random.normal(size=(width, width)))[0] for _ in range(-(-PROJECTIONS // width))]
    return np.column_stack(bases)[:, :PROJECTIONS]


def _search_block(
    points: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Ids and scores of the best verified points of each query, best first, ties to smaller ids."""
    order = np.argsort(ids, kind="stable")
    points, ids = points[order], ids[order]
    n, width = points.shape
    scale = np.abs(points).max()
    unit = points / scale
    squares = (unit * unit).sum(axis=1)
    lifted = np.column_stack([unit, np.sqrt(np.maximum(squares.max() - squares, 0))])
    lines = _lines(width + 1)
    on_lines = lifted @ lines
    placed = np.argsort(on_lines, axis=0, kind="stable")
    columns = np.ascontiguousarray(np.take_along_axis(on_lines, placed, axis=0).T)
    sorted_points = np.ascontiguousarray(placed.T)
    spread = np.maximum(on_lines.std(axis=0), 1e-12)
    # Queries are brought to the norm of the points; that does not change their order of points.
    at = queries / np.abs(queries).max(axis=1, keepdims=True)
    at *= np.sqrt(squares.max()) / np.sqrt((at * at).sum(axis=1, keepdims=True))
    at = at @ lines[:width]
    enough = min(n, max(ENOUGH, int(SHARE * n)))
    opened: dict[int, list[np.ndarray]] = {}

    def windows(step: int) -> list[np.ndarray]:
        """First place in and first place after the windows of all queries, per query and line."""
        if step not in opened:
            half = FIRST * GROWTH**step * spread[:, None] + 1e-9
            opened[step] = [
                np.array([np.searchsorted(c, v) for c, v in zip(columns, edge, strict=True)]).T
                for edge in (at.T - half, at.T + half)
            ]
        return opened[step]

    step = 0
    for q in range(len(queries)):
        step = max(0, step - 1)  # one below where the query before ended
        count = np.zeros(n, np.int64)
        low = high = windows(step)[0][q]
        while True:
            wider_low, wider_high = (edge[q] for edge in windows(step))
            reached = [p[a:b] for p, a, b in zip(sorted_points, wider_low, low, strict=True)]
            reached += [p[a:b] for p, a, b in zip(sorted_points, high, wider_high, strict=True)]
            count += np.bincount(np.concatenate(reached), minlength=n)
            low, high = wider_low, wider_high
            candidates = np.flatnonzero(count >= THRESHOLD)
            if len(candidates) >= enough:
                break
            step += 1
        candidates = candidates[ids[candidates] != query_ids[q]]
        scores = np.einsum("ij,j->i", points[candidates], queries[q])
        best = np.lexsort((ids[candidates], -scores))[:k]
        yield q, ids[candidates][best], scores[best]


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 20, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the `k` best found for each query.

    Both tables have `vec_id` and `embedding`; a query does not find its own vec_id. Vectors that
    are null, empty, zero or not finite in every component, and rows without vec_id, take no part.
    Shorter vectors count as padded with zeros. Repeated rows are each found. Other columns are not
    read; without candidates there are no rows.
    """
    columns = [
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    ]
    points, asked = (
        t.select(*columns).where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
        for t in (vectors, queries)
    )
    rows, width = points.agg(F.count("*"), F.max(F.size("embedding"))).first()
    asked_rows, asked_width = asked.agg(F.count("*"), F.max(F.size("embedding"))).first()
    width = max(width or 1, asked_width or 1)
    blocks, batches_of = max(1, -(-rows // block_rows)), max(1, -(-asked_rows // QUERY_ROWS))
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    batch = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(batches_of)).cast("int")

    def everywhere(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    sent = points.select(
        block.alias("block"), everywhere(batches_of).alias("batch"), F.lit(0).alias("kind"), *columns
    ).unionAll(
        asked.select(
            everywhere(blocks).alias("block"), batch.alias("batch"), F.lit(1).alias("kind"), *columns
        )
    )
    keys = ["block", "batch"]
    dealt = sent.repartition(exchange.parts(vectors.sparkSession), *keys).sortWithinPartitions(*keys)

    def padded(vectors: list) -> np.ndarray:
        out = np.zeros((len(vectors), width))
        for row, v in zip(out, vectors, strict=True):
            row[: len(v)] = v
        return out

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in exchange.grouped(batches, *keys):
            kind = np.array(rows["kind"])
            ids, data = np.array(rows["vec_id"]), padded(rows["embedding"])
            if (kind == 0).all() or (kind == 1).all():
                continue
            mine, query_ids = kind == 0, ids[kind == 1]
            found = list(_search_block(data[mine], ids[mine], data[~mine], query_ids, k))
            sizes = [len(f[1]) for f in found]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(query_ids, sizes)),
                    pa.array(np.concatenate([f[1] for f in found])),
                    pa.array(np.concatenate([f[2] for f in found])),
                ],
                names=["query_id", "vec_id", "score"],
            )

    found = dealt.mapInArrow(work, "query_id bigint, vec_id bigint, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (
        found.withColumn("rank", rank)
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
