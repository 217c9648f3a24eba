"""License scan: winnowed fingerprints pick candidates, banded alignment reports coverage and spans.

Each template is cut into runs of GRAM words; of every WINNOW neighbouring runs the one with the
smallest hash goes into an inverted index (hash -> templates and places). A document's runs are
looked up in it. Hits whose diagonals span at most BAND words form a candidate, and the template is
aligned with that stretch of the document, BAND words beyond it on both sides, as often as it finds
a match in words that no better match of the template has taken.

Words are compared in lower case and without the punctuation around them, which also takes comment
signs away. A match then has to have every word that tells its license from others of its family,
and none that would turn its meaning.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm.words import Words, chunks

GRAM = 3
WINNOW = 2
BAND = 8
COVERAGE = 0.8
_GNU_HEADER = (
    "{} is free software: you can redistribute it and/or modify it under the terms of the GNU {} "
    "License as published by the Free Software Foundation, either version {} of the License, or "
    "(at your option) any later version."
)
_GNU_NOTICE = "This work is licensed under the GNU {} License, version {}."
_CC_NAMES = {"BY": "Attribution", "NC": "NonCommercial", "ND": "NoDerivatives", "SA": "ShareAlike"}
_CC_KINDS = ["BY", "BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND"]
_CC_VERSIONS = {"3.0": "3.0 Unported", "4.0": "4.0 International"}
_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
    "software and associated documentation files (the \"Software\"), to deal in the Software "
    "without restriction, including without limitation the rights to use, copy, modify, merge, "
    "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
    "to whom the Software is furnished to do so, subject to the following conditions:"
)
_BSD_CONDITIONS = (
    "Redistribution and use in source and binary forms, with or without modification, are "
    "permitted provided that the following conditions are met:"
)
_BSD_TWO = (
    "Redistributions of source code must retain the above copyright notice, this list of conditions "
    "and the following disclaimer. Redistributions in binary form must reproduce the above copyright "
    "notice, this list of conditions and the following disclaimer in the documentation and/or other "
    "materials provided with the distribution."
)
_BSD_THIRD = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to "
    "endorse or promote products derived from this software without specific prior written permission."
)
_ISC_GRANT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
    "without fee is hereby granted, provided that the above copyright notice and this permission "
    "notice appear in all copies."
)
#: Texts of common licenses, grants and headers, and short notices that name one.
TEMPLATES = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to "
        "in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License "
        "for the specific language governing permissions and limitations under the License."
    ),
    "BSD conditions": _BSD_CONDITIONS,
    "BSD-2-Clause text": f"{_BSD_CONDITIONS} {_BSD_TWO}",
    "BSD-3-Clause text": f"{_BSD_CONDITIONS} {_BSD_TWO} {_BSD_THIRD}",
    "BSL-1.0 grant": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy "
        "of the software and accompanying documentation covered by this license (the \"Software\") "
        "to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare "
        "derivative works of the Software, and to permit third-parties to whom the Software is "
        "furnished to do so, all subject to the following:"
    ),
    "CC0-1.0 dedication": (
        "To the extent possible under law, the author(s) have dedicated all copyright and related and "
        "neighboring rights to this software to the public domain worldwide. This software is "
        "distributed without any warranty."
    ),
    **{
        f"CC-{kind}-{version} notice": f"Licensed under CC {kind} {version}."
        for kind in _CC_KINDS
        for version in _CC_VERSIONS
    },
    **{
        f"CC-{kind}-{version} sentence": (
            "This work is licensed under a Creative Commons "
            f"{'-'.join(_CC_NAMES[part] for part in kind.split('-'))} {title} License."
        )
        for kind in _CC_KINDS
        for version, title in _CC_VERSIONS.items()
    },
    "EPL-2.0 header": (
        "This program and the accompanying materials are made available under the terms of the "
        "Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"
    ),
    "GPL-3.0 notice": _GNU_NOTICE.format("General Public", 3),
    "GPL-2.0 notice": _GNU_NOTICE.format("General Public", 2),
    "AGPL-3.0 notice": _GNU_NOTICE.format("Affero General Public", 3),
    "LGPL-3.0 notice": _GNU_NOTICE.format("Lesser General Public", 3),
    "LGPL-2.1 notice": _GNU_NOTICE.format("Lesser General Public", 2.1),
    "GPL-3.0 header": _GNU_HEADER.format("This program", "General Public", 3),
    "GPL-2.0 header": _GNU_HEADER.format("This program", "General Public", 2),
    "AGPL-3.0 header": _GNU_HEADER.format("This program", "Affero General Public", 3),
    "LGPL-3.0 header": _GNU_HEADER.format("This program", "Lesser General Public", 3),
    "LGPL-2.1 header": _GNU_HEADER.format("This library", "Lesser General Public", 2.1),
    "ISC grant": _ISC_GRANT,
    "MIT notice": "Released under the MIT License.",
    "MIT grant": _MIT_GRANT,
    "MIT text": (
        f"{_MIT_GRANT} The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT "
        "WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
        "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN "
        "AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
        "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "MPL-1.1 header": (
        "The contents of this file are subject to the Mozilla Public License Version 1.1 (the "
        "\"License\"); you may not use this file except in compliance with the License. You may obtain "
        "a copy of the License at http://www.mozilla.org/MPL/"
    ),
    "MPL-2.0 header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
        "copy of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/."
    ),
    "Unlicense dedication": (
        "This is free and unencumbered software released into the public domain. Anyone is free to "
        "copy, modify, publish, use, compile, sell, or distribute this software, either in source code "
        "form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
    ),
    "Zlib grant": (
        "Permission is granted to anyone to use this software for any purpose, including commercial "
        "applications, and to alter it and redistribute it freely, subject to the following "
        "restrictions:"
    ),
}
#: Words that tell a license from others of its family: a match has them all. Versions as `2` for `2.0`.
REQUIRED = {
    **{
        f"{name} {part}": words
        for name, words in {
            "Apache-2.0": {"apache", "2"},
            "GPL-3.0": {"general", "3"},
            "GPL-2.0": {"general", "2"},
            "AGPL-3.0": {"affero", "3"},
            "LGPL-3.0": {"lesser", "3"},
            "LGPL-2.1": {"lesser", "2.1"},
        }.items()
        for part in ("notice", "header")
    },
    **{
        f"CC-{kind}-{version} notice": {"cc", kind.lower(), version.removesuffix(".0")}
        for kind in _CC_KINDS
        for version in _CC_VERSIONS
    },
    **{
        f"CC-{kind}-{version} sentence": {
            "-".join(_CC_NAMES[part] for part in kind.split("-")).lower(),
            version.removesuffix(".0"),
        }
        for kind in _CC_KINDS
        for version in _CC_VERSIONS
    },
    "BSL-1.0 grant": {"organization", "third-parties"},
    "CC0-1.0 dedication": {"dedicated", "domain"},
    "EPL-2.0 header": {"eclipse", "2"},
    "MIT notice": {"mit"},
    "MIT text": {"noninfringement"},
    "MPL-1.1 header": {"mozilla", "1.1"},
    "MPL-2.0 header": {"mozilla", "2"},
    "BSD-3-Clause text": {"endorse", "promote"},
}
#: Words that a match must not have: negations of a grant, and names of sibling licenses.
FORBIDDEN = {
    **{name: {"not"} for name in ("BSD conditions", "ISC grant", "MIT grant", "BSL-1.0 grant", "Zlib grant")},
    **{name: {"not"} for name in ("MIT notice", "Unlicense dedication", "CC0-1.0 dedication")},
    **{
        f"GPL-{version} {part}": {"lesser", "library", "affero"}
        for version in ("3.0", "2.0")
        for part in ("notice", "header")
    },
}
SCHEMA = """doc_id bigint, license string, coverage double, n_matched int, n_template int,
    start bigint, end bigint"""
FIELDS = [
    ("doc_id", pa.int64()),
    ("license", pa.string()),
    ("coverage", pa.float64()),
    ("n_matched", pa.int32()),
    ("n_template", pa.int32()),
    ("start", pa.int64()),
    ("end", pa.int64()),
]


_ROUND_WORDS = np.zeros(256, bool)
_ROUND_WORDS[[b for b in range(33, 127) if not chr(b).isalnum()]] = True
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def bare(texts: pa.Array) -> pa.Array:
    """The texts with the punctuation around words blanked out, byte for byte; within words it stays."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    joined = b"".join(texts.to_pylist())
    data = np.frombuffer(joined, np.uint8).copy()
    bounds = np.cumsum([0, *pa.compute.binary_length(texts).to_pylist()])
    marks = _ROUND_WORDS[data]
    edge = np.ones(len(data) + 2, bool)  # also before and after all texts
    edge[1:-1] = _BLANK[data]
    # Runs of marks, which end where a text does; one next to a blank or the end of a text goes.
    first = np.zeros(len(data) + 1, bool)
    first[bounds] = True
    starts = marks & (first[:-1] | ~np.concatenate([[False], marks[:-1]]))
    begin = np.flatnonzero(starts)
    stops = marks & (first[1:] | ~np.concatenate([marks[1:], [False]]))
    end = np.flatnonzero(stops) + 1
    open_before = edge[begin] | first[begin]
    open_after = edge[end + 1] | first[end]
    change = np.zeros(len(data) + 1, np.int64)
    gone = open_before | open_after
    change[begin[gone]] += 1
    change[end[gone]] -= 1
    data[np.cumsum(change[:-1]) > 0] = 32
    offsets = pa.py_buffer(bounds.astype(np.int64))
    return pa.Array.from_buffers(pa.large_binary(), len(texts), [None, offsets, pa.py_buffer(data)])


class Index:
    """Inverted index of the templates' fingerprints; its size follows from the templates."""

    def __init__(self, templates: dict[str, str]):
        cut = {name: Words(bare(pa.array([t])), lower=True) for name, t in templates.items()}
        self.words = {name: words.hashes for name, words in cut.items()}
        places: dict[int, list[tuple[str, int]]] = defaultdict(list)
        for name, words in cut.items():
            at, hashes = words.windows(GRAM)
            picked = set()
            for k in range(max(1, len(at) - WINNOW + 1)):
                near = hashes[k : k + WINNOW]
                if len(near):
                    picked.add(k + int(near.argmin()))
            for k in sorted(picked):
                places[int(hashes[k])].append((name, int(at[k])))
        self.places = dict(places)
        self.hashes = np.array(sorted(self.places), np.uint64)


def align(
    template: np.ndarray, words: np.ndarray, start: int, band: int = BAND, reach: int = 0
) -> tuple:
    """(matched words, first and last matched place) of the template placed at about `start`.

    The most words in common order, from `band` before `start` to `band` after `start + reach`; of
    equal ones the alignment that starts last, then the one that ends first.
    """
    none = (0, -1, 1)
    width = 2 * band + reach + 1
    row = [none] * width
    for i in range(len(template)):
        new = []
        for d in range(width):
            j = start + i + d - band
            best = row[d]
            if 0 <= j < len(words) and words[j] == template[i]:
                n, first, _ = row[d]
                best = (n + 1, j if n == 0 else first, -j)
            above = row[d + 1] if d < width - 1 else none
            before = new[d - 1] if d else none
            new.append(max(best, above, before))
        row = new
    n, first, last = max(row)
    return n, first, -last


def _candidates(hits: list[tuple[str, int]]) -> Iterator[tuple[str, int, int]]:
    """Template, first and last diagonal of each cluster; none spans more than BAND."""
    cluster: tuple[str, int, int] | None = None
    for name, diagonal in sorted(hits):
        if cluster and cluster[0] == name and diagonal - cluster[1] <= BAND:
            cluster = name, cluster[1], diagonal
            continue
        if cluster:
            yield cluster
        cluster = name, diagonal, diagonal
    if cluster:
        yield cluster


def _matches(
    template: np.ndarray, words: np.ndarray, spots: list[tuple[int, int]], coverage: float
) -> list[tuple]:
    """(n, first, last) of all matches that do not overlap, those of most words first taken."""
    least = coverage * len(template)
    free = words.copy()
    heap: list[tuple] = []

    def push(low: int, high: int, start: int, stop: int) -> None:
        """Align the cluster with each free stretch of the words from start to stop."""
        start, stop = max(start, 0), min(stop, len(free))
        cuts = [start - 1, *(start + np.flatnonzero(free[start:stop] == 0)).tolist(), stop]
        for a, b in zip(cuts, cuts[1:]):
            a += 1
            if b - a < least or np.isin(template, free[a:b]).sum() < least:
                continue
            n, first, last = align(template, free[a:b], low - a, reach=high - low)
            if n and n >= least:
                heapq.heappush(heap, (-n, last - first, a + first, a + last, low, high, a, b))

    for low, high in spots:
        push(low, high, low - BAND, high + BAND + len(template))
    found = []
    while heap:
        n, _, first, last, *cluster = heapq.heappop(heap)
        # Words only get taken, so a match that is still free is still the best of its stretch.
        if free[first : last + 1].all():
            found.append((-n, first, last))
            free[first : last + 1] = 0
        push(*cluster)
    return sorted(found, key=lambda m: m[1])


def _told_apart(name: str, span: bytes) -> bool:
    """Whether the words of a match have those that its template requires, and no forbidden one."""
    words = bare(pa.array([span]))[0].as_py().decode().lower().split()
    plain = {w.removeprefix("v").removesuffix(".0") for w in words} | set(words)
    return REQUIRED.get(name, set()) <= plain and not FORBIDDEN.get(name, set()) & plain


def _best(matches: list[tuple], lengths: dict[str, int]) -> list[tuple]:
    """Of overlapping matches the one of most words, then of most coverage."""
    kept: list[tuple] = []
    taken = np.zeros(max((m[3] for m in matches), default=0) + 1, bool)
    for name, n, first, last in sorted(matches, key=lambda m: (-m[1], lengths[m[0]], m[2:], m[0])):
        if not taken[first : last + 1].any():
            kept.append((name, n, first, last))
            taken[first : last + 1] = True
    return sorted(kept, key=lambda m: m[2])


def scan(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """One row per license text found: coverage, words matched and span in code points.

    Of overlapping templates the one with most words matched is reported.

    Whole texts are scanned, each row by itself; nothing is shuffled. Null text has no licenses, and
    neither has a text with fewer than GRAM words in common. Repeated rows are reported each; rows
    without doc_id are reported without; other columns are not read.
    """
    templates = TEMPLATES if templates is None else templates

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(templates)
        lengths = {name: len(words) for name, words in index.words.items()}
        for rows in chunks(batches):
            words = Words(bare(rows.column("text")), lower=True)
            at, hashes = words.windows(GRAM)
            found = np.flatnonzero(np.isin(hashes, index.hashes))
            hits: dict[int, list[tuple[str, int]]] = defaultdict(list)
            for k in found.tolist():
                doc = int(words.doc[at[k]])
                for name, place in index.places[int(hashes[k])]:
                    hits[doc].append((name, int(at[k] - words.offsets[doc]) - place))
            out = []
            for doc, mine in hits.items():
                own = words.hashes[words.offsets[doc] : words.offsets[doc + 1]]
                text = rows.column("text")[doc].as_py()
                pieces = text.encode()
                base = int(words.bounds[doc])
                starts = words.starts[words.offsets[doc] : words.offsets[doc + 1]] - base
                spots = defaultdict(list)
                for name, low, high in _candidates(mine):
                    spots[name].append((low, high))
                matches = [
                    (name, *match)
                    for name in spots
                    for match in _matches(index.words[name], own, spots[name], coverage)
                ]
                ends = [*starts[1:].tolist(), len(pieces)]
                matches = [m for m in matches if _told_apart(m[0], pieces[starts[m[2]] : ends[m[3]]])]
                for name, n, first, last in _best(matches, lengths):
                    template = index.words[name]
                    end = starts[last] + len(pieces[starts[last] :].split(None, 1)[0])
                    span = [len(pieces[:cut].decode()) for cut in (starts[first], end)]
                    doc_id = rows.column("doc_id")[doc].as_py()
                    out.append((doc_id, name, round(n / len(template), 4), n, len(template), *span))
            columns = list(zip(*out, strict=True)) if out else [[] for _ in FIELDS]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, (_, kind) in zip(columns, FIELDS, strict=True)],
                names=[name for name, _ in FIELDS],
            )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(work, SCHEMA)
