"""Training-order materialisation of token sequences.

Every document is encoded and cut into sequences of LENGTH tokens. A document reserves as many
places as it has bytes / LENGTH, an upper bound of its sequences known before encoding; a keyed
Feistel permutation with cycle-walking over all places deals each sequence a place in training
order. Ranges of places are shards: files of fixed stride in that order, holding the places in use
without gaps. A sequence's global slot is its row in the shard plus the rows of the shards before.

A shard file is written under a task's own name and moved to its final one, and its content follows
from the input, so lost or repeated tasks leave the same files.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickweave.llm import exchange
from clickweave.llm.secret_scan import _encoding
from clickweave.llm.words import mix
from clickweave.session import materialize, scratch_dir

LENGTH = 256
#: Places per shard; about four in ten are in use, since a token has about 2.5 bytes.
SHARD_PLACES = 1 << 16
ROUNDS = 6
KEY = 20240611
#: Pads the last sequence of a document; the vocabulary has no token of this number.
PAD = 50256


def permute(index: np.ndarray, size: int, key: int = KEY) -> np.ndarray:
    """Place of each index under a permutation of range(size)."""
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    out = index.astype(np.uint64)
    walking = np.arange(len(out))
    while len(walking):
        right, left = out[walking] & mask, out[walking] >> np.uint64(half)
        for k in range(ROUNDS):
            salt = np.uint64((key + 0x9E3779B97F4A7C15 * (k + 1)) % 2**64)
            left, right = right, left ^ (mix(right ^ salt) & mask)
        out[walking] = (left << np.uint64(half)) | right
        walking = walking[out[walking] >= size]
    return out


def _places(rows: pa.RecordBatch, length: int) -> np.ndarray:
    size = pc.fill_null(pc.binary_length(rows.column("text").cast(pa.large_binary())), 0)
    return -(-np.asarray(size, np.int64) // length)


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path; Arrow knows Hadoop's names of S3 by one name."""
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", uri))


def _reserve(rows: DataFrame, length: int) -> dict[int, int]:
    """Places that each partition of the input reserves: one number per task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sum(int(_places(b, length).sum()) for b in batches)
        yield pa.RecordBatch.from_pydict(
            {"part": pa.array([TaskContext.get().partitionId()]), "places": pa.array([total])}
        )

    counted = rows.mapInArrow(work, "part bigint, places bigint").collect()
    return {r["part"]: r["places"] for r in counted}


def write_shards(
    docs: DataFrame,
    vocabulary: str,
    pattern: str,
    folder: str | None = None,
    length: int = LENGTH,
    shard_places: int = SHARD_PLACES,
    key: int = KEY,
) -> DataFrame:
    """Write the shards and return doc_id, sequence, slot, shard, row, n_tokens, crc32 and file.

    Tokens are little-endian unsigned 16-bit numbers, `length` per row; n_tokens of them are not
    padding. Null and empty text has no sequences; rows without doc_id and repeated rows are written
    like others; other columns are not read. The input must come in the same order whenever it is
    read, as files do; two sequences at one place are an error. Without rows no file is written.
    """
    spark = docs.sparkSession
    folder = folder or scratch_dir(spark, "shards")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    reserved = _reserve(rows, length)
    parts = sorted(reserved)
    starts = dict(zip(parts, np.cumsum([0, *(reserved[p] for p in parts)]).tolist()))
    size = sum(reserved.values())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(vocabulary, pattern)
        at = starts.get(TaskContext.get().partitionId(), 0)
        for whole in batches:
            for rows in exchange.chunks([whole]):
                first = at + np.cumsum([0, *_places(rows, length)])
                at = int(first[-1])
                out: list[tuple] = []
                texts, ids = rows.column("text").to_pylist(), rows.column("doc_id").to_pylist()
                for text, doc_id, index in zip(texts, ids, first.tolist()):
                    tokens = np.array(encoding.encode_ordinary(text or ""), "<u2")
                    for k in range(0, len(tokens), length):
                        sequence = k // length
                        out.append((doc_id, sequence, index + sequence, tokens[k : k + length].tobytes()))
                columns = list(zip(*out)) if out else [[], [], [], []]
                place = permute(np.array(columns[2], np.int64), max(size, 1), key).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(place // shard_places),
                        pa.array(place),
                        pa.array(columns[0], pa.int64()),
                        pa.array(columns[1], pa.int32()),
                        pa.array(columns[3], pa.binary()),
                    ],
                    names=["shard", "place", "doc_id", "sequence", "tokens"],
                )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        store.create_dir(root, recursive=True)
        current, stream, row, partial, last = None, None, 0, "", None

        def finish() -> None:
            if stream is not None:
                stream.close()
                store.move(partial, f"{root}/{current:08d}.bin")

        for batch in batches:
            shards = batch.column("shard").to_numpy()
            values = batch.column("tokens").to_pylist()
            places = batch.column("place").to_pylist()
            numbers, checks, files = [], [], []
            for shard, place, value in zip(shards.tolist(), places, values, strict=True):
                if place == last:
                    raise RuntimeError("two sequences have one place; give an input of stable order")
                last = place
                if shard != current:
                    finish()
                    current, row = shard, 0
                    partial = f"{root}/{shard:08d}.{uuid.uuid4().hex}.part"
                    stream = store.open_output_stream(partial)
                padding = np.full(length - len(value) // 2, PAD, "<u2").tobytes()
                stream.write(value + padding)
                numbers.append(row)
                checks.append(zlib.crc32(value))
                files.append(f"{folder}/{shard:08d}.bin")
                row += 1
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("sequence"),
                    batch.column("shard"),
                    pa.array(numbers, pa.int64()),
                    pa.array([len(v) // 2 for v in values], pa.int32()),
                    pa.array(checks, pa.int64()),
                    pa.array(files, pa.string()),
                ],
                names=["doc_id", "sequence", "shard", "row", "n_tokens", "crc32", "file"],
            )
        finish()

    n_parts = exchange.parts(spark)
    dealt = (
        rows.mapInArrow(
            encode, "shard bigint, place bigint, doc_id bigint, sequence int, tokens binary"
        )
        .repartitionById(n_parts, F.pmod("shard", F.lit(n_parts)).cast("int"))
        .sortWithinPartitions("shard", "place")
    )
    schema = (
        "doc_id bigint, sequence int, shard bigint, row bigint, n_tokens int, crc32 bigint, file string"
    )
    manifest = materialize(dealt.mapInArrow(write, schema), "manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        manifest.groupBy("shard")
        .agg(F.count("*").alias("n"))
        .select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )
    return manifest.join(offsets, "shard").select(
        "doc_id",
        "sequence",
        (F.col("offset") + F.col("row")).alias("slot"),
        "shard",
        "row",
        "n_tokens",
        "crc32",
        "file",
    )


def read_rows(file: str, start: int = 0, length: int = LENGTH) -> Iterator[np.ndarray]:
    """Sequences of a shard file from row `start` on: a reader that stopped goes on from there."""
    store, path = _store(file)
    with store.open_input_file(path) as stream:
        stream.seek(start * 2 * length)
        while value := stream.read(2 * length):
            yield np.frombuffer(value, "<u2")
