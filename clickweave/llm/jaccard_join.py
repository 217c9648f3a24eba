"""Similarity join of documents on word shingles by T-occurrence search.

1. Equal shingle sets form a class. A class can only have a link if three quarters of its shingles
   occur in other classes too; a packed exchange of 32-bit shingle hashes finds those classes, and
   passages that many otherwise different documents share drop out here. Hash collisions can only
   keep a class too many.
2. Two linked sets share one of the first n - ceil(0.75 n) + 1 shingles in any fixed order; rare
   ones come first here, by a second packed exchange of counts. Classes that share one, directly or
   through others, form a family.
3. In each family a DivideSkip search runs over its inverted lists: a set's T - 1 longest lists are
   set aside, the others merged, and every set found is completed by binary probes of the long ones.
   Sets already known to be connected are not compared again, as only components are wanted.
4. A family of more than BLOCK classes is cut into blocks, and every pair of blocks is searched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm import exchange
from clickweave.llm.components import components, with_extremes
from clickweave.llm.words import Words, mix, pack, runs, unpack
from clickweave.session import materialize

SHINGLE = 5
PERCENT = 75
BLOCK = 4096
NODES = "doc_id bigint, n_shingles int, class binary, candidate boolean"
SETS = "class binary, shingles binary"
PREFIXES = "class binary, prefix array<bigint>"


class Sets:
    """Distinct shingles of a chunk: `hashes` and `doc` ordered by place, and per-document figures."""

    def __init__(self, texts: pa.Array):
        words = Words(texts, lower=True)
        at, hashes = words.windows(SHINGLE)
        doc = words.doc[at]
        for n in range(1, SHINGLE):
            short = np.flatnonzero(words.counts == n)
            start, total = words.offsets[short], np.zeros(len(short), np.uint64)
            for k in range(n):
                total += mix(words.hashes[start + k] + np.uint64(k))
            hashes = np.concatenate([hashes, mix(total ^ np.uint64(n))])
            doc = np.concatenate([doc, short])
        order = np.argsort(doc, kind="stable")
        hashes, doc = hashes[order], doc[order]
        again = exchange.repeated(hashes)
        again = again[np.lexsort((again, doc[again], hashes[again]))]
        same = (np.diff(hashes[again]) == 0) & (np.diff(doc[again]) == 0)
        keep = np.ones(len(hashes), bool)
        keep[again[1:][same]] = False
        self.hashes, self.doc = hashes[keep], doc[keep]
        self.size = np.bincount(self.doc, minlength=len(texts))
        starts = runs(self.doc)
        self.keys = np.zeros((len(texts), 2), np.uint64)
        for column, salt in enumerate((0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)):
            if len(starts):
                sums = np.add.reduceat(mix(self.hashes ^ np.uint64(salt)), starts)
                present = self.doc[starts]
                self.keys[present, column] = mix(sums + self.size[present].astype(np.uint64))

    def classes(self) -> pa.Array:
        return pa.array([k.tobytes() for k in self.keys], pa.binary())


def _describe(n_parts: int):
    def work(chunk: int, rows: pa.RecordBatch) -> Iterator[exchange.Row]:
        sets = Sets(rows.column("text"))
        _, leader, leads = np.unique(sets.keys, axis=0, return_index=True, return_inverse=True)
        leader = leader[leads.ravel()]
        mine = leader[sets.doc] == sets.doc
        hashes, doc = sets.hashes[mine], sets.doc[mine]
        low = hashes.astype(np.uint32)
        shared = exchange.repeated(hashes)
        alone = np.ones(len(hashes), bool)
        alone[shared] = False
        settled = np.bincount(doc[shared], minlength=len(sets.size)).astype(np.uint32)
        shared = shared[runs(hashes[shared])]
        ids = rows.column("doc_id").to_numpy()
        yield (
            chunk % n_parts,
            chunk,
            1,
            pack(ids, sets.size.astype(np.uint32), sets.keys.ravel(), leader, settled),
        )
        told = dict(exchange.by_part(hashes[shared], n_parts))
        asked = dict(exchange.by_part(hashes[alone], n_parts))
        tell, ask, ask_doc = low[shared], low[alone], doc[alone]
        none = np.zeros(0, np.int64)
        for part in sorted(told.keys() | asked.keys()):
            picked = asked.get(part, none)
            owner, counts = np.unique(ask_doc[picked], return_counts=True)
            body = pack(
                ask[picked],
                np.diff(owner, prepend=0).astype(np.uint32),
                counts.astype(np.uint32),
                tell[told.get(part, none)],
            )
            yield part, chunk, 0, body

    return work


def _count_shared(rows: list[exchange.Row]) -> Iterator[exchange.Row]:
    """How many of the shingles asked for occur elsewhere, per document of each chunk."""
    pieces = [unpack(r[3], np.uint32, np.uint32, np.uint32, np.uint32) for r in rows]
    if not pieces:
        return
    asked = np.concatenate([p[0] for p in pieces])
    every = np.concatenate([asked, *(p[3] for p in pieces)])
    shared = np.zeros(len(every), bool)
    shared[exchange.repeated(every)] = True
    at = 0
    for (_, chunk, _, _), (own, steps, counts, _) in zip(rows, pieces, strict=True):
        owner = np.repeat(np.cumsum(steps, dtype=np.int64), counts)
        found, number = np.unique(owner[shared[at : at + len(own)]], return_counts=True)
        at += len(own)
        if len(found):
            yield 0, chunk, 0, pack(found.astype(np.uint32), number.astype(np.uint32))


def _judge(own: bytes, replies: list[bytes]) -> pa.RecordBatch:
    ids, size, keys, leader, settled = unpack(
        own, np.int64, np.uint32, np.uint64, np.int64, np.uint32
    )
    total = settled.astype(np.int64)
    for reply in replies:
        found, number = unpack(reply, np.uint32, np.uint32)
        total[found] += number
    candidate = (size > 0) & (100 * total >= PERCENT * size.astype(np.int64))
    classes = [k.tobytes() for k in keys.reshape(-1, 2)]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids),
            pa.array(size.astype(np.int32)),
            pa.array(classes, pa.binary()),
            pa.array(candidate[leader]),
        ],
        names=["doc_id", "n_shingles", "class", "candidate"],
    )


def _prefix_length(size: int) -> int:
    return size - -(-PERCENT * size // 100) + 1


def _load_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole sets of the candidate classes; a text of another class under the same id is skipped."""
    for rows in exchange.chunks(batches):
        sets = Sets(rows.column("text"))
        bounds = np.searchsorted(sets.doc, np.arange(rows.num_rows + 1))
        out: list[tuple] = []
        for k, (key, wanted) in enumerate(
            zip(sets.classes().to_pylist(), rows.column("class").to_pylist(), strict=True)
        ):
            if key == wanted:
                shingles = np.sort(sets.hashes[bounds[k] : bounds[k + 1]])
                out.append((key, shingles.tobytes()))
        columns = list(zip(*out, strict=True)) if out else [[], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.binary()) for c in columns], names=["class", "shingles"]
        )


def _chunk_id(rows: pa.RecordBatch) -> int:
    keys = b"".join(rows.column("class").to_pylist())
    return xxhash.xxh3_64_intdigest(keys) - (1 << 63)


def _shingles(rows: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(rows.column("shingles").to_pylist()), np.uint64)


def _ask_counts(n_parts: int):
    def work(_: int, rows: pa.RecordBatch) -> Iterator[exchange.Row]:
        distinct, counts = np.unique(_shingles(rows), return_counts=True)
        for part, picked in exchange.by_part(distinct, n_parts):
            body = pack(distinct[picked], counts[picked].astype(np.uint32))
            yield part, _chunk_id(rows), 0, body

    return work


def _add_counts(rows: list[exchange.Row]) -> Iterator[exchange.Row]:
    pieces = [unpack(r[3], np.uint64, np.uint32) for r in rows]
    if not pieces:
        return
    hashes = np.concatenate([p[0] for p in pieces])
    order = np.argsort(hashes)
    starts = runs(hashes[order])
    sums = np.add.reduceat(np.concatenate([p[1] for p in pieces])[order].astype(np.int64), starts)
    total = np.empty(len(hashes), np.uint32)
    total[order] = np.repeat(np.minimum(sums, 2**32 - 1), np.diff([*starts, len(hashes)]))
    at = 0
    for (part, chunk, _, _), (own, _) in zip(rows, pieces, strict=True):
        yield part, chunk, 0, pack(np.array([part]), total[at : at + len(own)])
        at += len(own)


def _own_sets(_: int, rows: pa.RecordBatch) -> Iterator[exchange.Row]:
    keys = np.frombuffer(b"".join(rows.column("class").to_pylist()), np.uint8)
    sizes = np.array([len(s) // 8 for s in rows.column("shingles").to_pylist()], np.uint32)
    yield 0, _chunk_id(rows), 1, pack(keys, sizes, _shingles(rows))


def _rarest(n_parts: int):
    def work(own: bytes, replies: list[bytes]) -> pa.RecordBatch:
        keys, sizes, shingles = unpack(own, np.uint8, np.uint32, np.uint64)
        distinct, place = np.unique(shingles, return_inverse=True)
        counts = np.zeros(len(distinct), np.uint32)
        dealt = dict(exchange.by_part(distinct, n_parts))
        for reply in replies:
            part, total = unpack(reply, np.int64, np.uint32)
            counts[dealt[int(part[0])]] = total
        mine, ends, out = counts[place], np.cumsum(sizes), []
        for end, size in zip(ends.tolist(), sizes.tolist(), strict=True):
            part = slice(end - size, end)
            rare = np.lexsort((shingles[part], mine[part]))[: _prefix_length(size)]
            # A shingle of one class alone leads nowhere.
            out.append(shingles[part][rare][mine[part][rare] > 1].view(np.int64))
        classes = [keys[k : k + 16].tobytes() for k in range(0, len(keys), 16)]
        return pa.RecordBatch.from_arrays(
            [pa.array(classes, pa.binary()), pa.array(out, pa.list_(pa.int64()))],
            names=["class", "prefix"],
        )

    return work


def prefixes(sets: DataFrame) -> DataFrame:
    """The rarest shingles of each class, as many as a linked class must share one of."""
    n_parts = exchange.parts_of(sets, "shingles")
    own = exchange.mapped(sets, _own_sets, column="shingles")
    asked = exchange.send(sets, _ask_counts(n_parts), n_parts, column="shingles")
    replies = exchange.answer(asked, _add_counts, own, merge=True)
    return exchange.collect(replies, _rarest(n_parts), PREFIXES)


def linked(sets: list[np.ndarray]) -> list[int]:
    """For each sorted set of shingles the first set that it is connected to."""
    parent = list(range(len(sets)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    shingles, token = np.unique(np.concatenate(sets), return_inverse=True)
    lists = owner[np.argsort(token, kind="stable")]
    length = np.bincount(token, minlength=len(shingles))
    ends = np.cumsum(length)
    ranges = np.cumsum([0, *size])
    apart = len(sets)
    for x, mine in enumerate(sets):
        if apart == 1:
            break
        tokens = token[ranges[x] : ranges[x + 1]]
        order = np.argsort(length[tokens], kind="stable")
        short = tokens[order[: _prefix_length(len(mine))]]
        long = np.sort(mine[order[_prefix_length(len(mine)) :]])
        merged = np.concatenate([lists[ends[t] - length[t] : ends[t]] for t in short.tolist()])
        found, count = np.unique(merged[merged > x], return_counts=True)
        fits = 100 * np.minimum(size[found], size[x]) >= PERCENT * np.maximum(size[found], size[x])
        for y, seen in zip(found[fits].tolist(), count[fits].tolist(), strict=True):
            a, b = root(x), root(y)
            if a == b:
                continue
            theirs = sets[y]
            at = np.searchsorted(theirs, long)
            at[at == len(theirs)] = 0
            seen += int(np.count_nonzero(theirs[at] == long))
            if 100 * seen >= PERCENT * (len(mine) + len(theirs) - seen):
                parent[max(a, b)] = min(a, b)
                apart -= 1
    return [root(i) for i in range(len(sets))]


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each class to the first of its component, per family or pair of blocks."""
    for rows in exchange.grouped(batches, "family", "low", "high"):
        whole = dict(zip(rows["class"], rows["shingles"], strict=True))
        classes = sorted(whole)
        roots = linked([np.frombuffer(whole[c], np.uint64) for c in classes])
        pairs = [(classes[i], classes[r]) for i, r in enumerate(roots) if i != r]
        columns = list(zip(*pairs, strict=True)) if pairs else [[], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.binary()) for c in columns], names=["a", "b"]
        )


def class_links(sets: DataFrame, block: int = BLOCK) -> DataFrame:
    """Edges that connect exactly the classes linked by similarity, from `class` and `shingles`."""
    tokens = materialize(prefixes(sets), "prefixes").select(
        "class", F.explode("prefix").alias("token")
    )
    hubs = with_extremes(tokens, "token", "class").where("class <> least")
    edges = hubs.select(F.col("class").alias("a"), F.col("least").alias("b"))
    families = materialize(
        components(edges).withColumnsRenamed({"node": "class", "root": "family"}), "families"
    )
    blocks = families.groupBy("family").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    mine = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    rows = sets.select("class", "shingles").join(families.join(blocks, "family"), "class")
    rows = rows.withColumn("mine", mine)
    other = F.explode(
        F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(
            F.filter(
                F.sequence(F.lit(0), F.col("blocks") - 1), lambda other: other != F.col("mine")
            )
        )
    )
    rows = rows.withColumn("other", other).select(
        "family",
        F.least("mine", "other").alias("low"),
        F.greatest("mine", "other").alias("high"),
        "class",
        "shingles",
    )
    keys = ["family", "low", "high"]
    dealt = rows.repartition(exchange.parts(sets.sparkSession), *keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(_search, "a binary, b binary")


def near_duplicates(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles and component_id of every row.

    Documents link when their sets of five-word shingles (A-Z in lower case) have a Jaccard
    similarity of 0.75 or more; component_id is the smallest doc_id reachable. Null, empty and blank
    texts have no shingles and are their own component. Rows without doc_id link nothing and have no
    component. Repeated rows and ids are rows of their own. Other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    known = rows.where("doc_id IS NOT NULL")
    n_parts = exchange.parts_of(known)
    sent = exchange.send(known, _describe(n_parts), n_parts)
    replies = exchange.answer(sent, _count_shared, merge=True)
    nodes = materialize(exchange.collect(replies, _judge, NODES), "nodes")
    leaders = nodes.where("candidate").groupBy("class").agg(F.min("doc_id").alias("doc_id"))
    sets = known.join(leaders, "doc_id").select("text", "class").mapInArrow(_load_sets, SETS)
    links = materialize(class_links(materialize(sets, "sets"), block), "links")
    roots = components(links).withColumnsRenamed({"node": "class"})
    placed = nodes.join(roots, "class", "left").select(
        "doc_id", "n_shingles", F.coalesce("root", "class").alias("root")
    )
    placed = materialize(placed, "placed")
    # A table of its own, as adaptive execution splits a hot root only between plain shuffles.
    smallest = materialize(placed.groupBy("root").agg(F.min("doc_id").alias("smallest")), "smallest")
    joined = placed.join(smallest, "root").select(
        "doc_id",
        F.col("n_shingles").cast("long").alias("n_shingles"),
        F.when(F.col("n_shingles") > 0, F.col("smallest"))
        .otherwise(F.col("doc_id"))
        .alias("component_id"),
    )
    return joined.unionAll(_without_id(rows))


def _without_id(rows: DataFrame) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in exchange.chunks(batches):
            sizes = Sets(batch.column("text")).size.astype(np.int64)
            empty = pa.nulls(batch.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [empty, pa.array(sizes), empty], names=["doc_id", "n_shingles", "component_id"]
            )

    schema = "doc_id bigint, n_shingles bigint, component_id bigint"
    return rows.where("doc_id IS NULL").mapInArrow(work, schema)
