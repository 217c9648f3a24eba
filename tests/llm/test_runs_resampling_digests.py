"""Periodic runs, importance resampling and fingerprints against brute force on small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clickweave.llm import digests, periodic_runs, queries, resampling
from tests.llm.test_llm import DOCS, _rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _more_rows() -> list[tuple]:
    texts = ["a b c " * 9, "x " * 6, "x " * 5, "n a n b " * 4 + "n a", "Ü-1 é\nÜ-1 é\n\nÜ-1 é", "q" * 90]
    texts += ["one\ntwo\n\nthree four\nfive", "w " * 40 + "v " * 40, "ab" * 200, "0123456789" * 30]
    return [(900 + k, t, "en", "src0", len(t), None, 1) for k, t in enumerate(texts)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    rows = spark.createDataFrame([*_rows(), *_more_rows()], DOCS)
    rows.repartition(3).write.parquet(f"{path}/documents.parquet")
    bench = [(1, "the w3 of w4 x\nw5 the"), (2, None), (3, "tion ing W6 the of")]
    spark.createDataFrame(bench, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


@pytest.fixture(scope="module")
def docs(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


# --- periodic runs ------------------------------------------------------------------------------


def _brute_runs(words, least=6, periods=4):
    n, found = len(words), []
    for q in range(1, n // periods + 1):
        s = 0
        while s < n - q:
            e = s
            while e < n - q and words[e] == words[e + q]:
                e += 1
            length = e - s + q
            if length >= max(least, periods * q):
                smaller = any(
                    all(words[i] == words[i + p] for i in range(s, s + length - p)) for p in range(1, q)
                )
                if not smaller:
                    found.append((s, length, q))
            s = e + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def _collapsed(words, found):
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@settings(max_examples=400, deadline=None)
@given(
    st.lists(st.lists(st.integers(0, 2), max_size=60), max_size=5),
    st.integers(1, 9),
    st.integers(3, 5),
)
def test_basic_runs_equal_brute_force(texts, least, periods):
    words = np.array([w for t in texts for w in t], np.int64)
    offsets = np.cumsum([0, *map(len, texts)])
    found = [tuple(r) for r in periodic_runs.basic_runs(words, offsets, least, periods).tolist()]
    assert found == [(d, *r) for d, t in enumerate(texts) for r in _brute_runs(t, least, periods)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 1), max_size=8), st.integers(2, 12), st.lists(st.integers(0, 1), max_size=9))
def test_basic_runs_of_powers(root, times, tail):
    words = root * times + tail + root * times
    found = periodic_runs.basic_runs(np.array(words, np.int64), np.array([0, len(words)]))
    assert [tuple(r[1:]) for r in found.tolist()] == _brute_runs(words)


def test_find_runs_on_texts(docs):
    plain = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    expected = Counter()
    for doc, text in plain:
        words = WORD.findall(text or "")
        if len(words) > 2000:
            continue
        found = _brute_runs(words)
        expected[doc, len(words), tuple(found), _collapsed(words, found)] += 1
    rows = periodic_runs.find_runs(docs).where("n_words <= 2000").collect()
    got = Counter((r[0], r[1], tuple(map(tuple, r["runs"])), r["collapsed"]) for r in rows)
    assert got == expected


def test_long_run_and_empty_table(spark, docs):
    text = "head " + "a b c " * 20_000 + "tail"
    row = periodic_runs.find_runs(spark.createDataFrame([(1, text)], "doc_id int, text string")).first()
    assert [tuple(r) for r in row["runs"]] == [(1, 60_000, 3)]
    assert row["collapsed"] == "head a b c tail"
    assert periodic_runs.find_runs(docs.where("false")).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.find_runs(docs, periods=2)


def _planted(doc, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def test_op11_query(spark, folder, docs):
    got = Counter(tuple(r) for r in queries.op11_periodic_runs(spark, folder).where("doc_id >= 0").collect())
    expected = Counter()
    for doc, text in docs.where("doc_id >= 0").select("doc_id", "text").collect():
        words = _planted(doc, text)
        # A long document is one repeated word; its runs are known without brute force.
        found = [(0, len(words), 1)] if len(set(words)) == 1 and len(words) > 5 else None
        if found is None:
            found = _brute_runs(words) if len(words) < 2000 else []
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
        listed = "".join(f"{s},{length},{q}\n" for s, length, q in found)
        expected[
            doc,
            len(found),
            *(best or (None, None, None)),
            1000 * best[1] // best[2] if best else None,
            hashlib.sha256(listed.encode()).hexdigest(),
            hashlib.sha256(_collapsed(words, found).encode()).hexdigest(),
        ] += 1
    assert got == expected


# --- importance resampling ----------------------------------------------------------------------

FEATURE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def _features(text):
    words = FEATURE_WORD.findall((text or "").translate(LOWER))
    return [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)], len(words)


def _brute_resample(rows, bench, share=5, smallest=20):
    def buckets(text):
        return [zlib.crc32(f.encode()) % 10_000 for f in _features(text)[0]]

    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(buckets(text))
    for text in bench:
        t.update(buckets(text))
    all_s, all_t = sum(s.values()), sum(t.values())

    def gain(b):
        ratio = (t[b] + 1.0) * (all_s + 10_000) / ((s[b] + 1.0) * (all_t + 10_000))
        return math.floor(1000 * math.log(ratio))

    out = []
    for doc, text in rows:
        features, n = _features(text)
        weight = sum(gain(b) for b in buckets(text))
        score = None
        if doc is not None:
            h = int(hashlib.sha256(f"42:{doc}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        out.append([doc, n, len(features), weight, score, None])
    counted = [r for r in out if r[0] is not None and r[1] >= smallest]
    counted.sort(key=lambda r: (-r[4], r[0]))
    for k, row in enumerate(counted[: share * len(counted) // 100]):
        row[5] = k + 1
    return Counter(map(tuple, out))


@pytest.mark.parametrize("share", [5, 60, 100])
def test_resample_equals_brute_force(spark, docs, folder, share):
    target = spark.read.parquet(f"{folder}/benchmark.parquet")
    rows = [(r[0], r[1]) for r in docs.select("doc_id", "text").collect()]
    bench = [r[0] for r in target.select("text").collect()]
    got = Counter(map(tuple, resampling.resample(docs, target, share=share).collect()))
    assert got == _brute_resample(rows, bench, share)


def test_resample_of_copies_and_empty_tables(spark, docs, folder):
    target = spark.read.parquet(f"{folder}/benchmark.parquet")
    copies = [(k, "same line of words\n" * 8 + "x" * (k % 3)) for k in range(300)]
    many = spark.createDataFrame(copies, "doc_id bigint, text string")
    bench = [r[0] for r in target.select("text").collect()]
    got = Counter(map(tuple, resampling.resample(many, target).collect()))
    assert got == _brute_resample(copies, bench)
    assert resampling.resample(docs.where("false"), target).count() == 0
    unseen = Counter(map(tuple, resampling.resample(many, target.where("false")).collect()))
    assert unseen == _brute_resample(copies, [])


@pytest.mark.parametrize("name", ["op11_periodic_runs", "op12_importance_resampling"])
def test_queries_equal_their_sql(spark, docs, folder, tmp_path, name):
    # Rows without id and repeated rows are defined by the operators, not by the contract.
    docs.where("doc_id IS NOT NULL").distinct().write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = queries.QUERIES[name](spark, str(tmp_path))
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        files = f"{tmp_path}/{table}.parquet/*.parquet"
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{files}')")
    columns = ", ".join(rows.columns)
    expected = con.execute(f"SELECT {columns} FROM ({queries.ORACLE_SQL[name]})").fetchall()
    assert Counter(map(tuple, rows.collect())) == Counter(expected)


# --- fingerprints -------------------------------------------------------------------------------


def _entropy_class(window: bytes) -> int:
    part = {c: round(c * math.log2(c) * 2**20) for c in range(1, digests.WINDOW + 1)}
    most = part[digests.WINDOW]
    return (most - sum(part[c] for c in Counter(window).values())) * digests.CLASSES // most


def _brute_features(text: bytes, ranks) -> list[bytes]:
    w, f = digests.WINDOW, digests.FEATURES
    if len(text) < w:
        return [text] if text else []
    rank = [ranks[_entropy_class(text[i : i + w])] for i in range(len(text) - w + 1)]
    points = Counter()
    for i in range(len(rank) - f + 1):
        points[min(range(i, i + f), key=lambda j: (rank[j], j))] += 1
    chosen = sorted(i for i, p in points.items() if p >= digests.POINTS)
    if not chosen and points:
        chosen = sorted(i for i, p in points.items() if p == max(points.values()))
    if not chosen:
        chosen = [min(range(len(rank)), key=lambda j: (rank[j], j))]
    return list(dict.fromkeys(text[i : i + w] for i in chosen))


def _texts():
    rng = np.random.default_rng(3)
    letters = rng.choice(list("abcdefgh  \n"), 9000)
    prose = "".join(letters.tolist()).encode()
    texts = [b"", b"short", b"a" * 40, b"ab" * 300, prose, prose[:4000], prose[:90], prose[:31], prose[:32]]
    return [*texts, prose[:62], prose[:63], bytes(rng.integers(0, 256, 700, np.uint8)), prose[5:3000], b""]


def test_entropy_classes_and_popularity(monkeypatch):
    monkeypatch.setattr(digests, "BLOCK", 1000)
    texts = _texts()
    bounds = np.cumsum([0, *map(len, texts)])
    data = np.frombuffer(b"".join(texts), np.uint8)
    classes = digests.window_ranks(data, bounds, np.arange(digests.CLASSES + 1, dtype=np.uint16))
    w = digests.WINDOW
    for text, begin in zip(texts, bounds.tolist(), strict=False):
        expected = [_entropy_class(text[i : i + w]) for i in range(len(text) - w + 1)]
        assert classes[begin : begin + len(expected)].tolist() == expected
        left = classes[begin + len(expected) : begin + len(text)]
        assert (left == digests._NEVER).all()


def test_digests_hold_the_chosen_windows(monkeypatch):
    monkeypatch.setattr(digests, "BLOCK", 777)
    ranks = np.random.default_rng(1).permutation(digests.CLASSES + 1).astype(np.uint16)
    texts = _texts()
    for text, digest in zip(texts, digests.digests(texts, ranks), strict=True):
        features = _brute_features(text, ranks)
        assert digest.counts.sum() == len(features)
        assert digest.counts.tolist() == [
            len(features[k : k + digests.FULL]) for k in range(0, len(features), digests.FULL)
        ]
        for k, count in enumerate(digest.counts.tolist()):
            part = features[k * digests.FULL : k * digests.FULL + count]
            padded = np.array([list(x.ljust(digests.WINDOW, b"\0")) for x in part], np.uint8)
            hashes = digests._hashes(padded, np.array([len(x) for x in part]))
            bits = {(int(h) >> 11 * j) % digests.BITS for h in hashes for j in range(digests.HASHES)}
            stored = np.unpackbits(digest.filters[k].view(np.uint8))
            assert set(np.flatnonzero(stored).tolist()) == bits


def _brute_likeness(one, other):
    if not len(one.counts) or not len(other.counts):
        return float(len(one.counts) == len(other.counts))
    if one.counts.sum() > other.counts.sum():
        one, other = other, one
    sets = [
        [set(np.flatnonzero(np.unpackbits(f.view(np.uint8))).tolist()) for f in d.filters] for d in (one, other)
    ]
    total = 0.0
    for n, a in zip(one.counts.tolist(), sets[0], strict=True):
        best = 0.0
        for b in sets[1]:
            chance = len(a) * len(b) / digests.BITS
            beyond = len(a & b) - chance
            if beyond > digests.NOISE * math.sqrt(chance):
                best = max(best, beyond / (min(len(a), len(b)) - chance))
        total += n * best
    return total / one.counts.sum()


def test_likeness():
    ranks = np.arange(digests.CLASSES + 1, dtype=np.uint16)
    found = digests.digests(_texts(), ranks)
    for one in found:
        assert digests.likeness(one, one) == 1.0
        for other in found:
            assert digests.likeness(one, other) == pytest.approx(_brute_likeness(one, other))
            assert digests.likeness(one, other) == pytest.approx(digests.likeness(other, one), abs=0.2)
    whole, half, other = found[4], found[5], found[11]
    assert digests.likeness(whole, half) > 0.9
    assert digests.likeness(whole, other) < 0.1


def test_ranks_count_all_documents(docs):
    n = Counter()
    for (text,) in docs.select("text").collect():
        data = (text or "").encode()[:3000]
        n.update(_entropy_class(data[i : i + digests.WINDOW]) for i in range(len(data) - digests.WINDOW + 1))
    short = docs.selectExpr("doc_id", "cast(substr(cast(text AS binary), 1, 3000) AS string) AS text")
    order = sorted(range(1, digests.CLASSES + 1), key=lambda c: (n[c], c))
    assert np.argsort(digests.entropy_ranks(short)).tolist() == [*order, 0]


def test_op13_query(spark, folder, docs):
    rows = queries.op13_document_digests(spark, folder).collect()
    assert len(rows) == docs.count()
    ranks = digests.entropy_ranks(docs)
    plain = docs.selectExpr("doc_id", "xxhash64(text) AS k", "coalesce(text, '') AS text").collect()
    order = sorted((r for r in plain if r["doc_id"] is not None), key=lambda r: (-r["doc_id"], r["k"]))
    expected = Counter()
    for k, row in enumerate(order):
        following = order[(k + 1) % len(order)]["text"]
        text, half = row["text"], len(row["text"]) // 2
        edited = text[: len(text) - half] + following[:half]
        own, new, nxt = digests.digests([text.encode(), edited.encode(), following.encode()], ranks)
        expected[
            row["doc_id"],
            len(text),
            hashlib.sha256(edited.encode()).hexdigest(),
            str(own),
            str(new),
            digests.likeness(own, new),
            digests.likeness(own, nxt),
        ] += 1
    assert Counter(tuple(r) for r in rows if r["doc_id"] is not None) == expected
    alone = [r for r in rows if r["doc_id"] is None]
    assert all(r["edited_sha256"] is None and r["near_next"] is None for r in alone)
    prints = {r["fingerprint"] for r in digests.fingerprints(docs, ranks).where("doc_id IS NULL").collect()}
    assert {r["fingerprint"] for r in alone} == prints


def test_single_row_and_empty_table(spark, docs):
    ranks = np.arange(digests.CLASSES + 1, dtype=np.uint16)
    one = spark.createDataFrame([(7, "some words " * 30, "clash")], "doc_id bigint, text string, part string")
    row = digests.compare_spliced(one, ranks).first()
    assert row["near_next"] == 1.0
    assert row["n_chars"] == 330
    assert digests.compare_spliced(docs.where("false"), ranks).count() == 0
    assert digests.entropy_ranks(docs.where("false")).max() == digests.CLASSES
