"""Connected components of a graph held as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.session import materialize

ROUNDS = 60
#: A key's rows are dealt over up to this many groups.
SALTS = 256


def components(edges: DataFrame) -> DataFrame:
    """`node` and `root` (smallest node it reaches) for every node with an edge.

    `edges` has two columns `a` and `b`. Each round links all neighbours of a node to the smallest
    of them, larger ones first, then smaller ones; stars are left in the end. No node's neighbours
    are gathered in a list, and every round is a table in the checkpoint folder.
    """
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = materialize(links.distinct(), "links")
    before = None
    for _ in range(ROUNDS):
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        links = _to_smallest(both, "b > a")
        links = materialize(_to_smallest(links, None), "links")
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)


def with_extremes(rows: DataFrame, key: str, value: str) -> DataFrame:
    """All rows, with `least` and `most`, the extremes of `value` among the rows of the same key.

    A key is dealt over as many groups as its values hash to, so a key held by a third of all rows
    does not end in one task. Extremes go back to the groups that have rows, so no more of them
    move than there are rows. Rows with a null key are left out.
    """
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(value), F.lit(SALTS)).cast("int"))
    partial = salted.groupBy(key, "salt").agg(F.min(value).alias("least"), F.max(value).alias("most"))
    whole = partial.groupBy(key).agg(
        F.min("least").alias("least"), F.max("most").alias("most"), F.collect_list("salt").alias("salts")
    )
    back = whole.select(key, F.explode("salts").alias("salt"), "least", "most")
    return salted.join(back, [key, "salt"]).drop("salt")


def _to_smallest(links: DataFrame, only: str | None) -> DataFrame:
    """Link the neighbours of each node, and the node itself, to the smallest of them all."""
    found = with_extremes(links, "a", "b").withColumn("least", F.least("a", "least"))
    if only is None:  # all neighbours are smaller; the row of the largest one stands for the node
        pairs = F.array(F.struct(F.col("b").alias("a"), "least"), F.struct("a", "least"))
        pair = F.explode(F.when(F.col("b") == F.col("most"), pairs).otherwise(F.slice(pairs, 1, 1)))
        moved = found.select(pair.alias("pair")).select("pair.a", F.col("pair.least").alias("b"))
        return moved.where("a <> b").distinct()
    moved = found.where(only)
    return moved.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
