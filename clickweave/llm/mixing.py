"""Mixing sources to target weights by iterative proportional fitting.

Token counts of source x language x topic cells are raked, one margin after the other, until all
three margins have their target shares. The mixture has a stated number of tokens: the rate of a
cell is its raked share of them over its present tokens. A document appears as often as the whole
part of its cell's rate, and once more with the rest as probability, so a rare cell is repeated and
takes nothing from the others.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickweave.session import materialize

MARGINS = ["source", "lang", "topic"]
#: Target share of a value: its present share to this power, normalised. 1 keeps the margin, 0
#: makes its values equal.
POWERS = {"source": 0.5, "lang": 0.7, "topic": 1.0}
TOLERANCE = 1e-6
ROUNDS = 30
#: Cells are broadcast up to this number and joined by a shuffle beyond it.
BROADCAST_CELLS = 50_000
SEED = 71


def word_count(text: Column) -> Column:
    words = F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+")
    return F.size(F.array_remove(words, "")).cast("long")


def topic_of(text: Column, n_tokens: Column) -> Column:
    """Kind of text by layout and length, for tables without a topic column."""
    text = F.coalesce(text, F.lit(""))
    pipes = F.length(text) - F.length(F.replace(text, F.lit("|"), F.lit("")))
    return (
        F.when(10 * pipes > n_tokens, "tabular")
        .when(n_tokens < 100, "short")
        .when(n_tokens < 1000, "medium")
        .otherwise("long")
    )


def _key(name: str) -> Column:
    """A margin's value as a text that is never null, so that rows of a null value meet in joins."""
    return F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit(""))


def _value(name: str) -> Column:
    return F.when(F.col(name) != "", F.expr(f"substring({name}, 2)"))


def _cells(rows: DataFrame, powers: dict[str, float]) -> DataFrame:
    cells = rows.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("present"))
    cells = materialize(cells.where("present > 0"), "cells")
    for name in MARGINS:
        shares = cells.groupBy(name).agg(F.pow(F.sum("present"), powers[name]).alias("raw"))
        total = shares.agg(F.sum("raw")).first()[0] or 1.0
        target = shares.select(name, (F.col("raw") / total).alias(f"target_{name}"))
        cells = cells.join(target, name)
    return cells.withColumn("raked", F.col("present").cast("double"))


def rake(cells: DataFrame) -> DataFrame:
    """Scale `raked` until every margin has its `target_` shares; a table is written per round.

    `residual` is the largest share by which the last round still moved a margin of the cell. Targets
    that the cells cannot meet together leave one after ROUNDS rounds, and a warning names the margins.
    """
    cells = materialize(cells, "raked")
    for _ in range(ROUNDS):
        off = []
        for name in MARGINS:
            margin = F.sum("raked").over(Window.partitionBy(name))
            factor = F.col(f"target_{name}") / margin
            # In the first margin the total is still the one that the round before left, 1.
            cells = cells.withColumn(f"factor_{name}", factor)
            cells = cells.withColumn("raked", F.col("raked") * F.col(f"factor_{name}"))
            off.append(F.abs(F.col(f"factor_{name}") - 1).alias(name))
        cells = materialize(cells.withColumn("residual", F.greatest(*off)), "raked")
        worst = cells.agg(*[F.max(o).alias(n) for n, o in zip(MARGINS, off, strict=True)]).first()
        cells = cells.drop(*[f"factor_{name}" for name in MARGINS])
        unmet = {n: w for n, w in worst.asDict().items() if w is not None and w >= TOLERANCE}
        if not unmet:
            break
    else:
        if unmet:
            warnings.warn(f"margins that {ROUNDS} rounds of raking did not meet: {unmet}", stacklevel=2)
    return cells


def mix(
    docs: DataFrame,
    powers: dict[str, float] | None = None,
    topic: Column | None = None,
    seed: int = SEED,
    tokens: float | None = None,
) -> DataFrame:
    """All rows of `docs` as `row`, with margins, n_tokens, rate, residual, copies, probability, selected.

    The copies have `tokens` tokens in expectation, as many as `docs` if None. `rate` is the expected
    number of copies; `probability` is that of at least one, `selected` says that there is one;
    `repeated` makes the copies rows.

    Tokens are words. Null source, language or topic is a value of its own, apart from "". Documents
    without words belong to no cell: rate 0 and no residual. The copies of a document depend on its
    id, text and the seed, so equal rows share their fate and runs agree; null ids count as equal. Extra columns
    stay inside `row`; an empty table gives no rows. Targets that the present cells cannot meet
    together are approached for ROUNDS rounds; `residual` says how far off a document's cell is (`rake`).
    """
    text = F.col("text")
    rows = docs.select(
        F.struct("*").alias("row"),
        "doc_id",
        text,
        "source",
        "lang",
        word_count(text).alias("n_tokens"),
    )
    kind = topic_of(F.col("text"), F.col("n_tokens")) if topic is None else topic
    rows = rows.withColumn("topic", kind).withColumns({name: _key(name) for name in MARGINS})
    cells = rake(_cells(rows.select(*MARGINS, "n_tokens"), powers or POWERS))
    cells = materialize(cells.select(*MARGINS, "present", "raked", "residual"), "rates")
    count, present, raked = cells.agg(F.count("*"), F.sum("present"), F.sum("raked")).first()
    scale = (present if tokens is None else tokens) / raked if raked else 0.0
    rate = F.round(F.col("raked") / F.col("present") * scale, 9)
    cells = cells.select(*MARGINS, rate.alias("rate"), "residual")
    # 53 bits of a hash as a number in [0, 1).
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "text"), 11) / F.lit(2.0**53)
    joined = rows.join(F.broadcast(cells) if count <= BROADCAST_CELLS else cells, MARGINS, "left")
    counted = F.col("n_tokens") > 0
    rate = F.when(counted, F.coalesce("rate", F.lit(0.0))).otherwise(0.0)
    residual = F.when(counted, F.col("residual")).alias("residual")
    whole = F.floor(rate)
    copies = (whole + (draw < rate - whole).cast("long")).alias("copies")
    margins = [_value(name).alias(name) for name in MARGINS]
    drawn = joined.select("row", "doc_id", *margins, "n_tokens", rate.alias("rate"), residual, copies)
    return drawn.select(
        "*",
        F.least("rate", F.lit(1.0)).alias("probability"),
        (F.col("copies") > 0).alias("selected"),
    )


def repeated(mixed: DataFrame) -> DataFrame:
    """The documents of the mixture with their own columns, each as often as it has copies."""
    some = mixed.where("selected")
    copy = F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy")
    return some.select("row", copy).select("row.*")
