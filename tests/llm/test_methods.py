"""Parts of operators against plain versions of their methods."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from clickweave.llm import (
    bpe,
    exchange,
    jaccard_join,
    materialise,
    mixing,
    neighbours,
    quality,
    secret_scan,
    substring_dedup,
)
from clickweave.llm.components import components

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
TEXTS = "doc_id bigint, text string"


def _sorted(rows) -> list[tuple]:
    return sorted((tuple(r) for r in rows), key=repr)


def _prose(rng: random.Random, n: int, kinds: int = 500) -> str:
    return " ".join(f"w{rng.randrange(kinds)}" for _ in range(n))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    rng = random.Random(11)
    passage, base = _prose(rng, 40), _prose(rng, 200).split()
    texts = [None, "", passage, passage, *(f"{_prose(rng, 20)} {passage} {_prose(rng, 9)}" for _ in range(6))]
    for k in range(40):
        copy = list(base)
        copy[5 * k] = f"changed{k}"
        texts.append(" ".join(copy))
    rows = [*enumerate(texts), *((100 + i, _prose(rng, rng.randrange(1, 300))) for i in range(60))]
    path = str(tmp_path_factory.mktemp("texts"))
    spark.createDataFrame([*rows, rows[2]], TEXTS).repartition(3).write.parquet(f"{path}/t")
    return spark.read.parquet(f"{path}/t")


@pytest.mark.parametrize("part_bytes", [700, 4096])
def test_more_parts_than_tasks_give_the_same_rows(stored, monkeypatch, part_bytes):
    def results():
        return [
            _sorted(substring_dedup.remove_spans(stored).collect()),
            _sorted(jaccard_join.near_duplicates(stored).collect()),
            _sorted(bpe.encode(stored, WORD_BPE).collect()),
        ]

    tasks = exchange.parts(stored.sparkSession)
    assert exchange.parts_of(stored) == tasks
    want = results()
    monkeypatch.setattr(exchange, "PART_BYTES", part_bytes)
    assert exchange.parts_of(stored) > 2 * tasks
    assert results() == want


def test_a_part_is_answered_at_a_time(stored, monkeypatch):
    """No call gets rows of two parts, and no part is met twice."""

    def ask(chunk, rows):
        for part in range(11):
            yield part, chunk, 0, b"x"
        yield 0, chunk, 1, b"own"

    def reply(rows):
        assert len({r[0] for r in rows}) <= 1
        yield from ((0, chunk, 0, str(rows[0][0]).encode()) for _, chunk, _, _ in rows)

    sent = exchange.send(stored, ask, 11, chunk_bytes=2000)
    got = exchange.answer(sent, reply).where("kind = 0").groupBy("chunk").agg(
        F.sort_array(F.collect_list(F.col("body").cast("string").cast("int"))).alias("parts")
    )
    assert all(r["parts"] == list(range(11)) for r in got.collect())


def _stretches(place, own_doc, docs, inside, window):
    """The factors by trying every window's source word by word."""
    known = {p: (o, d, p - i) for p, o, d, i in zip(place, own_doc, docs, inside)}
    found = set()
    for p in sorted(known):
        first = last = p
        while before := [x for x in range(first - window, first) if known.get(x) == known[p]]:
            first = before[0]
        while after := [x for x in range(last + 1, last + window + 1) if known.get(x) == known[p]]:
            last = after[-1]
        found.add((first, last + window, known[p][1], first - known[p][2]))
    inner = {f for f in found for g in found if f[:2] != g[:2] and g[0] <= f[0] and f[1] <= g[1]}
    best = {}
    for f in sorted(found - inner):
        best.setdefault(f[:2], f)
    return sorted(best.values())


def test_factors_equal_a_plain_parse():
    rng = random.Random(4)
    for _ in range(300):
        window = rng.randrange(1, 5)
        place, own_doc, docs, inside = [], [], [], []
        distance = {}
        for p in range(40):
            doc = p // 20
            if p % 20 > 20 - window or rng.random() < 0.3:
                continue
            source = rng.randrange(2)
            if rng.random() < 0.1:
                distance[doc, source] = rng.randrange(-9, 3)
            place.append(p)
            own_doc.append(doc)
            docs.append(source)
            inside.append(p - distance.get((doc, source), 0))
        arrays = [np.array(x, np.int64) for x in (place, own_doc, docs, inside)]
        got = sorted(zip(*(x.tolist() for x in substring_dedup.grow(*arrays, window)), strict=True))
        want = _stretches(place, own_doc, docs, inside, window)
        assert [g[:2] for g in got] == [w[:2] for w in want]
        covered = {x for p in place for x in range(p, p + window)}
        assert covered == {x for start, end, *_ in got for x in range(start, end)}


def test_a_window_of_another_source_does_not_cut_a_factor(spark):
    """A copied text of which single passages also occur in earlier documents is one factor."""
    rng = random.Random(6)
    words = [f"u{i}" for i in range(1000)]
    rows = [(1, f"{_prose(rng, 30)} {' '.join(words[300:313])} x"), (3, " ".join(words[700:724]))]
    rows += [(50, f"start {' '.join(words)}"), (60, f"{_prose(rng, 20)} {' '.join(words)} end")]
    found = substring_dedup.duplicate_spans(spark.createDataFrame(rows, TEXTS).coalesce(1)).collect()
    factors = {r["doc_id"]: [tuple(f) for f in r["factors"]] for r in found}
    assert factors[60] == [(20, 1000, 50, 1)]
    assert factors[50] == [(301, 13, 1, 30), (701, 24, 3, 0)]


def test_components_of_a_large_star(spark):
    star = [(n, 5000) for n in range(1, 4000)] + [(n, n + 1) for n in range(6000, 6050)]
    found = components(spark.createDataFrame(star, "a bigint, b bigint")).collect()
    want = [(n, 1) for n in [*range(1, 4000), 5000]] + [(n, 6000) for n in range(6000, 6051)]
    assert _sorted(found) == _sorted(want)


def test_neighbours_of_equal_score_come_by_id(spark):
    rows = [(i, [1.0, 0.0] if i % 2 else [0.5, 0.5], 0) for i in range(60)]
    odd = [(60, [float("inf"), 1.0], 0), (80, [float("-inf"), 0.0], 0), (61, [float("nan"), 1.0], 0), (63, [], 0)]
    table = spark.createDataFrame([*rows, *odd], "vec_id bigint, embedding array<double>, score int")
    found = neighbours.nearest(table, table.where("vec_id in (1, 60, 80)"), 20, block_rows=16)
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found.orderBy("query_id", "rank").collect()]
    assert got == [(1, k, 2 * k + 1, 1.0) for k in range(1, 21)]


def test_windows_only_grow_and_counts_equal_a_recount():
    """What is found at a threshold equals counting every line anew at the radius reached."""
    rng = np.random.default_rng(5)
    points = rng.normal(size=(700, 8))
    found = list(neighbours._search_block(points, np.arange(700), points[:40], np.arange(40), 20))
    scores = points[:40] @ points.T
    hit = 0
    for q, ids, got in found:
        assert np.allclose(got, scores[q, ids]) and q not in ids and len(set(ids.tolist())) == 20
        best = [i for i in np.argsort(-scores[q]) if i != q][:20]
        hit += len({*best} & {*ids.tolist()})
    assert hit >= 0.9 * 20 * 40


def _mix_by_hand(rows, powers, seed):
    """Rates by proportional fitting of a dense array, and copies by the hash of id and text."""
    def topic(text, n):
        pipes = text.count("|")
        return "tabular" if 10 * pipes > n else "short" if n < 100 else "medium" if n < 1000 else "long"

    cell_of, present = {}, Counter()
    for k, (_, text, source, lang) in enumerate(rows):
        n = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        if n:
            cell_of[k] = (source, lang, topic(text, n))
            present[cell_of[k]] += n
    raked = {c: float(v) for c, v in present.items()}
    targets = []
    for axis, name in enumerate(("source", "lang", "topic")):
        raw = Counter()
        for c, v in present.items():
            raw[c[axis]] += v
        raw = {v: t ** powers[name] for v, t in raw.items()}
        targets.append({v: t / sum(raw.values()) for v, t in raw.items()})
    for _ in range(2000):
        for axis, target in enumerate(targets):
            now = Counter()
            for c, v in raked.items():
                now[c[axis]] += v
            raked = {c: v * target[c[axis]] / now[c[axis]] for c, v in raked.items()}
    scale = sum(present.values()) / sum(raked.values())
    out = []
    for k, (doc_id, text, _, _) in enumerate(rows):
        rate = raked[cell_of[k]] / present[cell_of[k]] * scale if k in cell_of else 0.0
        h = xxhash.xxh64(seed.to_bytes(4, "little"), 42).intdigest()
        if doc_id is not None:
            h = xxhash.xxh64(doc_id.to_bytes(8, "little"), h).intdigest()
        if text is not None:
            h = xxhash.xxh64(text.encode(), h).intdigest()
        out.append((doc_id, cell_of.get(k), rate, int(rate) + ((h >> 11) / 2.0**53 < rate % 1)))
    return out


def test_mixture_equals_fitting_and_drawing_by_hand(spark):
    rng = random.Random(8)
    rows = []
    for i in range(400):
        size = rng.choice([0, 3, 30, 120, 400])
        text = rng.choice([_prose(rng, size), "a | b | " * size]) if i % 29 else None
        rows.append((i if i % 31 else None, text, rng.choice(["x", "x", "y", "", None]), rng.choice(["en", "en", "", None])))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string")
    mixed = mixing.mix(docs).collect()
    want = _mix_by_hand(rows, mixing.POWERS, mixing.SEED)
    key = lambda r: (repr(r[0]), r[2], repr(r[1]))
    got = [
        (r["doc_id"], (r["source"], r["lang"], r["topic"]) if r["rate"] else None, r["rate"], r["copies"]) for r in mixed
    ]
    for a, b in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert a[:2] == b[:2] and a[3] == b[3] and a[2] == pytest.approx(b[2], rel=1e-4)
    assert all((r["residual"] is None) == (r["rate"] == 0) for r in mixed)
    assert max(r["residual"] for r in mixed if r["rate"]) < mixing.TOLERANCE


def test_margins_that_cannot_be_met_are_named(spark):
    """With one language per source, shares of both to different powers contradict each other."""
    rows = [(i, "a b c", "ab"[i % 10 == 0], ["en", "de"][i % 10 == 0]) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string")
    with pytest.warns(UserWarning, match="raking did not meet.*source.*lang"):
        mixed = mixing.mix(docs)
    assert mixed.agg(F.min("residual")).first()[0] > mixing.TOLERANCE


@pytest.mark.parametrize("length", [8, 64])
def test_slots_follow_the_permutation(spark, stored, tmp_path, length):
    path = f"{tmp_path}/one"
    stored.coalesce(1).write.parquet(path)
    one = spark.read.parquet(path)
    rows = [(r["doc_id"], r["text"] or "") for r in one.collect()]
    encoding = secret_scan._encoding(VOCABULARY, public_tokenizers.PATTERN)
    reserved = [-(-len(text.encode()) // length) for _, text in rows]
    first = np.cumsum([0, *reserved])
    sequences = [
        (first[k] + s, doc_id, s)
        for k, (doc_id, text) in enumerate(rows)
        for s in range(-(-len(encoding.encode_ordinary(text)) // length))
    ]
    place = materialise.permute(np.array([s[0] for s in sequences]), int(first[-1]))
    want = [sequences[k][1:] for k in np.argsort(place)]
    found = materialise.write_shards(one, VOCABULARY, public_tokenizers.PATTERN, length=length, shard_places=32)
    assert [(r["doc_id"], r["sequence"]) for r in found.orderBy("slot").collect()] == want


def test_the_permutation_has_its_key():
    orders = [materialise.permute(np.arange(1000), 1000, key).tolist() for key in (1, 2, 3)]
    assert all(a != b for a in orders for b in orders if a is not b)
    moved = defaultdict(int)
    for k, place in enumerate(orders[0]):
        moved[place // 100, k // 100] += 1
    assert len(moved) > 95  # neighbours are dealt over the whole range


def test_quality_fits_on_every_labelled_document(spark):
    """A corpus that is trusted as a whole has the trusted counts, however many labels there are."""
    docs = spark.range(20_100).select(F.col("id").alias("doc_id"), F.lit("good").alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    weights = quality.slot_weights(docs, quality.labelled_sample(labels))
    assert weights[xxhash.xxh64_intdigest("good", seed=42) % quality.SLOTS] == pytest.approx(0.0, abs=1e-12)
    fitted = quality.labelled_slots(docs, quality.labelled_sample(labels))
    assert fitted.count() == 20_100


def test_quality_verdicts_read_the_scores_of_the_threshold(spark):
    """Texts are worked through for the counts and once for scores, not again for the verdict."""
    docs = spark.createDataFrame(
        [(k, f"{'good' if k % 2 else 'bad'} word{k % 5} " * 15, "a") for k in range(40)], "doc_id long, text string, lang string"
    )
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) quality").where("doc_id < 20")
    found = quality.quality_rules(docs, labels)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" not in plan and "xxhash64" not in plan
    assert sorted(r["row"]["lang"] + r["row"]["text"] for r in found.collect()) == sorted(
        r["lang"] + r["text"] for r in docs.collect()
    )


def test_quality_counts_rows_without_id(spark):
    """They belong to the corpus, never to the trusted, and one of two equal ids doesn't hide the other."""
    rows = [(1, "x y"), (1, "x"), (2, "y"), (None, "x x z"), (None, None), (3, " "), (4, "\ty\n x ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1)], "doc_id long, quality int")
    weights = quality.slot_weights(docs, quality.labelled_sample(labels))

    def slots(text):
        words = [xxhash.xxh64_intdigest(w, seed=42) for w in (text or "").split()]
        seeds = [xxhash.xxh64_intdigest(a.to_bytes(8, "little"), seed=42) for a in words]
        pairs = [xxhash.xxh64_intdigest(b.to_bytes(8, "little"), seed=s) for s, b in zip(seeds, words[1:], strict=False)]
        return [h % quality.SLOTS for h in words + pairs]

    corpus = Counter(s for _, text in rows for s in slots(text))
    trusted = Counter(s for doc_id, text in rows if doc_id == 1 for s in slots(text))
    unseen = np.log((corpus.total() + quality.SLOTS) / (trusted.total() + quality.SLOTS))
    want = [unseen + np.log((trusted[s] + 1) / (corpus[s] + 1)) for s in range(quality.SLOTS)]
    assert weights == pytest.approx(want, abs=1e-12)


def test_repeated_words_of_random_texts(spark):
    """Few different words, so that runs of all lengths repeat, meet and overlap."""
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice(list("abcd"[: 1 + k % 4]), rng.integers(0, 60))) for k in range(120)]
    part = [f"w{k}" for k in range(40)]
    texts += [" ".join(part[:n] + ["-"] * gap + part[:n]) for n in (7, 8, 9, 15, 40) for gap in (0, 1)]
    docs = spark.createDataFrame([(k, text) for k, text in enumerate(texts)], "doc_id long, text string")
    found = quality.quality_rules(docs, docs.selectExpr("doc_id", "1 quality"), columns=["doc_id"])
    assert found.select("row.*").columns == ["doc_id"]
    for r in found.collect():
        words = texts[r["doc_id"]].split()
        windows = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
        starts = [k for k in range(len(words) - 7) if windows[tuple(words[k : k + 8])] > 1]
        assert r["n_repeat_words"] == len({k + j for k in starts for j in range(8)})
