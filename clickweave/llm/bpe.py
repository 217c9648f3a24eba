"""BPE encoding through a table of distinct words, and decoding through a table of pieces.

The tokenizer drops white space, so a text's ids are the ids of its words one after the other. A
chunk of documents is split into its distinct words and, per document, their positions. The words of
all chunks meet by hash, where each distinct word is encoded once; its ids go back to the chunks and
are joined to the positions. Words, not occurrences, are shuffled with their ids. The input is read
twice, for words and for positions, since positions then move once.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm import exchange
from clickweave.llm.words import pack, unpack

BATCH = 20_000
#: Text per chunk: larger chunks repeat fewer words among them.
CHUNK_BYTES = 8 << 20


@cache
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@cache
def _pieces(path: str) -> list[bytes]:
    """The id-to-piece table; its size is that of the vocabulary."""
    tokenizer = _tokenizer(path)
    last = max(tokenizer.get_vocab(with_added_tokens=True).values())
    return [(tokenizer.id_to_token(i) or "").encode() for i in range(last + 1)]


def _chunk_id(rows: pa.RecordBatch) -> int:
    """Both passes over a chunk find the same id, as it follows from the rows."""
    digest = xxhash.xxh3_64()
    for array in (rows.column("doc_id"), rows.column("text")):
        digest.update(np.asarray(pc.fill_null(pc.binary_length(array.cast(pa.string())), -1)))
        digest.update("".join(filter(None, array.cast(pa.string()).to_pylist())).encode())
    return digest.intdigest() - (1 << 63)


def _distinct(rows: pa.RecordBatch) -> tuple[list[bytes], np.ndarray, list[int]]:
    """Distinct words, most used first, the rank of every word, and words per document."""
    table: dict[bytes, int] = {}
    number = table.setdefault
    counts, seen = [], []
    for text in rows.column("text").cast(pa.large_binary()).to_pylist():
        words = (text or b"").split()
        counts.append(len(words))
        seen += [number(w, len(table)) for w in words]
    places = np.array(seen, np.int64)
    by_use = np.argsort(-np.bincount(places, minlength=len(table)), kind="stable")
    rank = np.empty(len(table), np.uint32)
    rank[by_use] = np.arange(len(table))
    words = list(table)
    return [words[w] for w in by_use.tolist()], rank[places], counts


def _positions(_: int, rows: pa.RecordBatch) -> Iterator[exchange.Row]:
    words, ranked, counts = _distinct(rows)
    ids = rows.column("doc_id")
    body = pack(
        ids.fill_null(0).to_numpy(),
        ids.is_valid().to_numpy(zero_copy_only=False),
        np.array(counts, np.uint32),
        np.array([len(words)], np.uint32),
        *((ranked >> np.uint32(shift)).astype(np.uint8) for shift in (0, 8, 16, 24)),
    )
    yield 0, _chunk_id(rows), 1, body


def _words(n_parts: int):
    def work(_: int, rows: pa.RecordBatch) -> Iterator[exchange.Row]:
        words, _, _ = _distinct(rows)
        chunk = _chunk_id(rows)
        dealt: list[list[int]] = [[] for _ in range(n_parts)]
        for rank, word in enumerate(words):
            dealt[zlib.crc32(word) % n_parts].append(rank)
        for part, ranks in enumerate(dealt):
            if ranks:
                joined = b" ".join([words[r] for r in ranks])
                steps = np.diff(np.array(ranks, np.uint32), prepend=np.uint32(0))
                yield part, chunk, 0, pack(steps, np.frombuffer(joined, np.uint8))

    return work


def _encode(path: str):
    def work(rows: list[exchange.Row]) -> Iterator[exchange.Row]:
        """Encode each distinct word of the part once, then answer every chunk."""
        table: dict[bytes, int] = {}
        asked = []
        for _, _, _, body in rows:
            _, joined = unpack(body, np.uint32, np.uint8)
            asked.append([table.setdefault(w, len(table)) for w in joined.tobytes().split(b" ")])
        words = list(table)
        lengths = np.zeros(len(words), np.int64)
        flat = []
        for start in range(0, len(words), BATCH):
            texts = [w.decode() for w in words[start : start + BATCH]]
            encoded = _tokenizer(path).encode_batch(texts, add_special_tokens=False)
            ids = [e.ids for e in encoded]
            lengths[start : start + len(ids)] = [len(i) for i in ids]
            flat.append(np.fromiter((x for i in ids for x in i), np.uint32))
        ids = np.concatenate([*flat, np.zeros(0, np.uint32)])
        ends = np.cumsum(lengths)
        for (_, chunk, _, body), wanted in zip(rows, asked, strict=True):
            wanted = np.array(wanted, np.int64)
            sizes = lengths[wanted]
            first = np.repeat(ends[wanted] - np.cumsum(sizes), sizes)
            picked = ids[first + np.arange(sizes.sum())] if len(sizes) else ids[:0]
            steps, _ = unpack(body, np.uint32, np.uint8)
            yield 0, chunk, 0, pack(steps, sizes.astype(np.uint32), picked)

    return work


def _join(path: str):
    def work(own: bytes, replies: list[bytes]) -> pa.RecordBatch:
        kinds = (np.int64, np.bool_, np.uint32, np.uint32, *[np.uint8] * 4)
        ids, valid, counts, size, *planes = unpack(own, *kinds)
        places = sum(p.astype(np.int64) << (8 * k) for k, p in enumerate(planes))
        size = int(size[0])
        word_ids: list[bytes | None] = [None] * size
        word_text: list[bytes] = [b""] * size
        lengths = np.zeros(size, np.int64)
        pieces = _pieces(path)
        for reply in replies:
            steps, sizes, flat = unpack(reply, np.uint32, np.uint32, np.uint32)
            ranks = np.cumsum(steps, dtype=np.int64)
            lengths[ranks] = sizes
            raw, listed, at = flat.astype("<u4").tobytes(), flat.tolist(), 0
            for r, n in zip(ranks.tolist(), sizes.tolist(), strict=True):
                word_ids[r] = raw[4 * at : 4 * (at + n)]
                word_text[r] = b" ".join([pieces[i] for i in listed[at : at + n]])
                at += n
        if None in word_ids:
            raise RuntimeError("chunks differ between runs of a task; give a stable input")
        encoded, decoded, n_tokens, at = [], [], [], 0
        empty = not lengths.all()
        for count in counts.tolist():
            mine = places[at : at + count]
            at += count
            n_tokens.append(int(lengths[mine].sum()))
            listed = mine.tolist()
            encoded.append(b"".join([word_ids[w] for w in listed]))
            if empty:
                listed = [w for w in listed if lengths[w]]
            decoded.append(b" ".join([word_text[w] for w in listed]).decode())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids, mask=~valid),
                pa.array(n_tokens, pa.int64()),
                pa.array(encoded, pa.binary()),
                pa.array(decoded, pa.string()),
            ],
            names=["doc_id", "n_tokens", "ids", "decoded"],
        )

    return work


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Ids of every whole text and what they decode to.

    One row per input row: doc_id, n_tokens, ids (little-endian unsigned 32-bit), decoded (the
    pieces joined by spaces, as a tokenizer without decoder does). Null and empty text have no ids;
    repeated rows come out repeated; other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    n_parts = exchange.parts_of(rows)
    positions = exchange.mapped(rows, _positions, CHUNK_BYTES)
    asked = exchange.send(rows, _words(n_parts), n_parts, CHUNK_BYTES)
    replies = exchange.answer(asked, _encode(tokenizer), positions)
    schema = "doc_id bigint, n_tokens bigint, ids binary, decoded string"
    return exchange.collect(replies, _join(tokenizer), schema)
