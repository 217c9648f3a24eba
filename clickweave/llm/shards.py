"""Sharding by vector bin packing on bytes, tokens and rows.

Groups of equal texts stay together. They are hashed into at most UNITS units, so the packing works
on a table of bounded size whatever the corpus; a group above a unit's fair share is a unit of its
own, and one above a shard's fair share is cut by rows into the fewest pieces that fit. Units are
placed from the largest down, each in the shard where the dot product of its vector with the
residual capacity is highest among those with room for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickweave.session import materialize

UNITS = 4096
#: Rows that one task numbers, about.
SLOT_ROWS = 100_000
SLACK = 1.001


def _measured(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("text_key"),
        F.size(F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")).cast("long").alias("tokens"),
    )


def place(units: list[tuple], shards: int) -> dict:
    """Shard of every unit from (key, bytes, tokens, rows); the residual is a share of a shard."""
    totals = [max(1, sum(u[k] for u in units)) for k in (1, 2, 3)]
    vectors = {u[0]: [shards * u[k] / totals[k - 1] for k in (1, 2, 3)] for u in units}
    residual = [[SLACK] * 3 for _ in range(shards)]
    out = {}
    for key in sorted(vectors, key=lambda k: (-sum(vectors[k]), k)):
        need = vectors[key]
        fits = [s for s in range(shards) if all(n <= r for n, r in zip(need, residual[s]))]

        def gain(s: int) -> tuple:
            return sum(n * r for n, r in zip(need, residual[s])), residual[s][0], -s

        # With room nowhere, the shard with most bytes left keeps the sizes near equal.
        best = max(fits, key=gain) if fits else max(range(shards), key=lambda s: residual[s][0])
        residual[best] = [r - n for r, n in zip(residual[best], need)]
        out[key] = best
    return out


def _piece(pieces: Column) -> Column:
    return F.pmod(F.xxhash64("doc_id", "text_crc32", F.lit("piece")), pieces).cast("int")


def balanced_shards(docs: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, tokens, shard and slot (gapless from 0 per shard) of every row.

    Sizes of the shards are near equal, tokens and rows as far as that allows. Null text counts as
    empty. Only a text holding more than a shard's share of the bytes or rows is spread over shards.
    Repeated rows are placed each; other columns are not read; an empty table gives no rows.
    """
    rows = materialize(_measured(docs), "measured")
    total = rows.agg(
        F.coalesce(F.sum("size"), F.lit(0)).alias("size"), F.count("*").alias("rows")
    ).first()
    groups = rows.groupBy("text_key").agg(
        F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")
    )
    # At most 2 * UNITS groups hold a unit's share of bytes or of rows, so this table is bounded.
    large = groups.where(
        (F.col("size") * UNITS > total["size"]) | (F.col("rows") * UNITS > total["rows"])
    ).withColumn(
        "pieces",
        F.ceil(
            F.greatest(
                F.col("size") * shards / max(1, total["size"]),
                F.col("rows") * shards / max(1, total["rows"]),
            )
        ).cast("int"),
    )
    large = materialize(large.select("text_key", "pieces"), "large")
    unit = F.when(
        F.col("pieces").isNotNull(), F.concat_ws(":", "text_key", _piece(F.col("pieces")))
    ).otherwise(F.pmod("text_key", F.lit(UNITS)).cast("string"))
    keyed = rows.join(F.broadcast(large), "text_key", "left").withColumn("unit", unit)
    units = keyed.groupBy("unit").agg(F.sum("size"), F.sum("tokens"), F.count("*")).collect()
    placed = place([tuple(u) for u in units], shards)
    spark = docs.sparkSession
    table = spark.createDataFrame(list(placed.items()), "unit string, shard int")
    sharded = keyed.join(F.broadcast(table), "unit").select(
        "doc_id", "size", "text_crc32", "tokens", "shard"
    )
    return _with_slots(sharded, max(1, -(-total["rows"] // SLOT_ROWS)))


def _with_slots(rows: DataFrame, buckets: int) -> DataFrame:
    """Number the rows of each shard: within hashed buckets, after the buckets before."""
    rows = rows.withColumn(
        "bucket", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(8 * buckets)).cast("int")
    )
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("shard", "bucket")
        .agg(F.count("*").alias("n"))
        .select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )
    order = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size", "tokens")
    numbered = rows.withColumn("place", F.row_number().over(order) - 1)
    return numbered.join(offsets, ["shard", "bucket"]).select(
        "doc_id",
        "size",
        "text_crc32",
        "tokens",
        "shard",
        (F.col("offset") + F.col("place")).cast("long").alias("slot"),
    )
