"""Quality rules and a hashed n-gram log-likelihood ratio, all in Spark expressions.

Words are mapped to SLOTS hashed slots, alone and in pairs. Two multinomials over the slots, one of
trusted documents and one of the whole corpus, give each slot the logarithm of their ratio; a
document's score is the mean over its n-grams. Every document is held against one threshold.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.session import materialize

SLOTS = 1 << 14
WINDOW = 8
SMOOTHING = 1.0
#: How much more a rejected good document costs than a kept bad one, as shares of their numbers.
GOOD_WEIGHT = 20.0
#: Scores are binned this finely to find the threshold: at most (range of scores) x BINS rows.
BINS = 1000
SPACE = r"[\x20\x09-\x0D]+"


def _once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once per row, however often lambdas read it."""
    return rows.select("*", F.explode(F.array(value)).alias(name))


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def _hashed(rows: DataFrame) -> DataFrame:
    """Add the words, their hashes, and the hashes of all pairs of neighbours."""
    rows = _once(rows, "words", _words(F.col("text")))
    rows = _once(rows, "hashes", F.transform("words", lambda w: F.xxhash64(w)))
    return _once(rows, "pairs", _joined(F.col("hashes"), 1))


def _joined(hashes: Column, step: int) -> Column:
    """Hash of each entry and the one `step` places on; runs of twice the words when runs meet."""
    return F.transform(
        F.slice(hashes, 1, F.greatest(F.size(hashes) - step, F.lit(0))),
        lambda h, i: F.xxhash64(h, F.get(hashes, i + step)),
    )


def _covered(windows: Column) -> Column:
    """Words within windows whose hash occurs twice or more."""
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def twice(ordered: Column) -> Column:
        starts = F.filter(
            F.transform(
                ordered,
                lambda x, i: F.when(
                    F.coalesce(F.get(ordered, i - 1)["h"] == x["h"], F.lit(False))
                    | F.coalesce(F.get(ordered, i + 1)["h"] == x["h"], F.lit(False)),
                    x["i"],
                ),
            ),
            lambda p: p.isNotNull(),
        )
        zero = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("total"))
        return F.aggregate(
            F.sort_array(starts),
            zero,
            lambda acc, p: F.struct(
                p.alias("last"),
                (acc["total"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("total"),
            ),
            lambda acc: acc["total"],
        )

    return F.get(F.transform(F.array(placed), twice), F.lit(0))


def _repeated_words(quads: Column) -> Column:
    """Words within windows that occur twice or more in the document, from its runs of four words.

    The second of two equal windows has WINDOW - 3 runs of four that were there before. Windows are
    made and compared only in documents with as many repeats.
    """

    def count(windows: Column) -> Column:
        repeats = F.size(F.array_distinct(windows)) < F.size(windows)
        return F.when(repeats, _covered(windows)).otherwise(0)

    possible = F.size(F.array_distinct(quads)) <= F.size(quads) - (WINDOW - 3)
    counted = F.get(F.transform(F.array(_joined(quads, WINDOW // 2)), count), F.lit(0))
    return F.when(possible, counted).otherwise(0)


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def labelled_ids(labels: DataFrame) -> DataFrame:
    """All labelled ids with their quality; quality 1 wins a tie."""
    return (
        labels.where("doc_id IS NOT NULL AND quality IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.max("quality").cast("int").alias("quality"))
    )


#: Its name when it was cut at a number of rows.
labelled_sample = labelled_ids


def with_labels(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """The labelled ones of the rows, with their quality.

    They meet by a shuffle, as the labels grow with the documents and are no broadcast.
    """
    return docs.join(labelled.hint("shuffle_hash"), "doc_id")


#: Its name when it carried the words and slots too.
labelled_slots = with_labels


def _texts(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """All texts, and whether they are trusted. Rows without id have no label and stay where they are."""
    trusted = labelled.where("quality = 1").select("doc_id", F.lit(True).alias("trusted"))
    named = docs.where("doc_id IS NOT NULL").join(trusted.hint("shuffle_hash"), "doc_id", "left")
    nameless = docs.where("doc_id IS NULL").select("text", F.lit(False).alias("trusted"))
    return named.select("text", F.coalesce("trusted", F.lit(False)).alias("trusted")).union(nameless)


def slot_weights(docs: DataFrame, labelled: DataFrame) -> list[float] | None:
    """Log ratio of the trusted to the corpus multinomial per slot; None without trusted words.

    Counts cover all documents and all trusted ones, in one pass; the result has SLOTS numbers,
    whatever the input. Words and their right neighbours become rows here, as compiled code counts
    them, while functions of arrays are interpreted.
    """
    words = _once(_texts(docs, labelled), "words", _words(F.col("text")))
    after = F.slice("words", 2, F.greatest(F.size("words"), F.lit(1)))
    neighbours = words.select(
        "trusted",
        F.inline(F.arrays_zip(F.col("words").alias("word"), after.alias("next"))).alias("word", "next"),
    )
    single, pair = F.xxhash64("word"), F.xxhash64(F.xxhash64("word"), F.xxhash64("next"))
    slots = F.array(_slot(single), F.when(F.col("next").isNotNull(), _slot(pair)))
    counted = (
        neighbours.select("trusted", F.explode(slots).alias("slot"))
        .where("slot IS NOT NULL")
        .groupBy("slot")
        .agg(F.count("*").alias("n"), F.count_if("trusted").alias("n_trusted"))
        .collect()
    )
    corpus, target = sum(r["n"] for r in counted), sum(r["n_trusted"] for r in counted)
    if not target:
        return None
    unseen = math.log((corpus + SMOOTHING * SLOTS) / (target + SMOOTHING * SLOTS))
    weights = [unseen] * SLOTS
    for r in counted:
        weights[r["slot"]] += math.log((r["n_trusted"] + SMOOTHING) / (r["n"] + SMOOTHING))
    return weights


def _slot(hash_: Column) -> Column:
    return hash_.bitwiseAND(SLOTS - 1)


def _score(hashes: Column, pairs: Column, weights: list[float]) -> Column:
    """Mean weight of a document's words and pairs of neighbours; null without words."""
    table = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")

    def add(total: Column, h: Column) -> Column:
        return total + F.get(table, _slot(h))

    total = F.aggregate(pairs, F.aggregate(hashes, F.lit(0.0), add), add)
    return F.when(F.size(hashes) > 0, total / (F.size(hashes) + F.size(pairs)))


def fit_threshold(scored: DataFrame, labelled: DataFrame) -> float:
    """The score that best parts labelled good from bad documents among those the base rules pass.

    It maximises GOOD_WEIGHT times the share of good kept plus the share of bad rejected, over
    binned scores, and lies in the middle of the gap there. Without bad labels every document passes.
    """
    bins = (
        with_labels(scored.where(~base_failed()).select("doc_id", "score"), labelled)
        .select("quality", F.floor(F.col("score") * BINS).alias("bin"))
        .groupBy("bin")
        .agg(F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("quality") == 0).alias("bad"))
        .orderBy("bin")
        .collect()
    )
    good, bad = sum(r["good"] for r in bins), sum(r["bad"] for r in bins)
    if not good or not bad:
        return -math.inf
    best, low, high = -1.0, -math.inf, -math.inf
    kept, rejected, below = good, 0, None
    for r in bins:
        gain = GOOD_WEIGHT * kept / good + rejected / bad
        if gain > best + 1e-12:
            best, low, high = gain, below if below is not None else r["bin"], r["bin"]
        kept, rejected, below = kept - r["good"], rejected + r["bad"], r["bin"] + 1
    return (low + high) / 2 / BINS


def _judged(docs: DataFrame, weights: list[float] | None) -> DataFrame:
    """The rows of `docs`, which are row, doc_id and text, with rule counts and score."""
    rows = _once(_hashed(docs), "quads", _joined(F.col("pairs"), 2))
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    duplicated = F.get(
        F.transform(F.array(lines), lambda x: F.size(x) - F.size(F.array_distinct(x))), F.lit(0)
    )
    score = _score(F.col("hashes"), F.col("pairs"), weights) if weights else F.lit(None).cast("double")
    return rows.select(
        "row",
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size(F.regexp_extract_all(text, F.lit(r"[#*$%&|<>]"), F.lit(0)))
        .cast("long")
        .alias("n_symbols"),
        duplicated.cast("long").alias("n_dup_lines"),
        _repeated_words(F.col("quads")).cast("long").alias("n_repeat_words"),
        score.alias("score"),
    )


def quality_rules(
    docs: DataFrame, labels: DataFrame, columns: list[str] | None = None
) -> DataFrame:
    """All rows of `docs` as `row`, with rule counts, score and verdict.

    Null text counts as empty; fewer than 20 words or many repeats fail the base rules whatever the
    score. Without trusted labels the score is null and the base rules alone decide. Repeated rows
    and ids are judged one by one; extra columns are kept inside `row`, or those named in `columns`.
    An empty table gives none. Scored rows are written once, for the threshold and the verdict.
    """
    labelled = labelled_ids(labels.select("doc_id", "quality"))
    weights = slot_weights(docs.select("doc_id", "text"), labelled)
    row = F.struct(*(columns or ["*"])).alias("row")
    rows, threshold = _judged(docs.select(row, "doc_id", "text"), weights), -math.inf
    if weights:
        rows = materialize(rows, "scored")
        threshold = fit_threshold(rows, labelled)
    accepted = F.coalesce(F.col("score") >= F.lit(threshold), F.lit(True))
    return rows.withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & accepted
    )
