"""Secret scan: patterns for known kinds, and random strings found by their token efficiency.

Text that a byte-pair vocabulary has seen packs many characters into a token; random strings do
not. Candidate strings with fewer than MAX_RATIO characters per token are reported, unless they are
digests of a known length, numbers, identifiers whose letter parts all look like words, or wholly
inside a finding of a known kind.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import itertools
import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import pyarrow.compute
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_RATIO = 2.0
#: Characters per token from which a letter part of an identifier counts as a word.
WORD_RATIO = 3.0
KINDS = ["assign", "access", "hex", "random"]
#: Key words that the assign pattern starts with; any letter case.
KEYWORDS = ["password", "passwd", "secret", "token", "api_key", "apikey"]
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
#: Lengths in hexadecimal characters of MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512.
DIGEST_LENGTHS = {32, 40, 56, 64, 96, 128}
UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
LETTER_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@cache
def _encoding(vocabulary: str, pattern: str) -> tiktoken.Encoding:
    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def known(value: str, encoding: tiktoken.Encoding) -> bool:
    """Digests, UUIDs, numbers and other strings without letters, and identifiers made of words."""
    if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", value) and len(value) in DIGEST_LENGTHS:
        return True
    return bool(UUID.fullmatch(value)) or all(
        len(part) >= WORD_RATIO * len(encoding.encode_ordinary(part))
        for part in LETTER_PART.findall(value)
    )


def spans_of(text: str, encoding: tiktoken.Encoding, max_ratio: float = MAX_RATIO) -> list[tuple]:
    """(start, kind number, end) of all findings in code points, ordered by start, then kind."""
    found = []
    lowered = text.lower()
    if any(word in lowered for word in KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    found.sort()
    starts = [start for start, _, _ in found]
    reach = list(itertools.accumulate((end for _, _, end in found), max))
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        before = bisect.bisect_right(starts, start)
        covered = before and reach[before - 1] >= end
        if covered or end - start >= max_ratio * len(encoding.encode_ordinary(m[0])):
            continue
        if not known(m[0], encoding):
            found.append((start, 3, end))
    return sorted(found)


def _joined(spans: list[tuple]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


SCHEMA = """doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, n_random bigint,
    base_sha256 string, spans string"""


def scan(docs: DataFrame, vocabulary: str, pattern: str, max_ratio: float = MAX_RATIO) -> DataFrame:
    """One row per document with counts and spans of its secrets.

    A row depends on its own text alone, so nothing is shuffled. Null text is empty and has no
    spans; repeated rows are scanned each; other columns are not read; no rows give no rows.
    """
    names = [part.split()[0] for part in SCHEMA.split(",")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(vocabulary, pattern)
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for text in batch.column("text").to_pylist():
                spans = spans_of(text or "", encoding, max_ratio)
                base = [s for s in spans if s[1] < 3]
                counts = [sum(s[1] == kind for s in spans) for kind in range(4)]
                digest = hashlib.sha256(_joined(base).encode()).hexdigest()
                for column, value in zip(out[1:], (*counts, digest, _joined(spans)), strict=True):
                    column.append(value)
            out[0] = batch.column("doc_id")
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            arrays = [pa.array(c, k) if isinstance(c, list) else c for c, k in zip(out, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(work, SCHEMA)


def redact(docs: DataFrame, vocabulary: str, pattern: str, mask: str = "[secret]") -> DataFrame:
    """The documents with every span found replaced by a mask; columns and rows stay as they are.

    Overlapping spans are masked together. `n_chars`, where present as a whole number, follows the
    new text. Null text stays null.
    """
    columns = docs.columns
    counted = dict(docs.dtypes).get("n_chars") in ("int", "bigint")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(vocabulary, pattern)
        for batch in batches:
            texts = []
            for text in batch.column("text").to_pylist():
                parts, at = [], 0
                for start, _, end in spans_of(text or "", encoding):
                    if start >= at:
                        parts += [text[at:start], mask]
                    at = max(at, end)
                texts.append("".join([*parts, text[at:]]) if parts else text)
            arrays = dict(zip(columns, batch.columns, strict=True))
            arrays["text"] = pa.array(texts, pa.string())
            if counted:
                lengths = pa.array([None if t is None else len(t) for t in texts])
                kept = pa.compute.if_else(arrays["n_chars"].is_null(), None, lengths)
                arrays["n_chars"] = kept.cast(arrays["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(arrays.values()), names=columns)

    return docs.mapInArrow(work, docs.schema)
