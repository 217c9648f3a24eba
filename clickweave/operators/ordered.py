"""Ordered operators that do not put a whole group into one task.

`lag` or a running sum over a plain window needs all rows of a group in one task. Here each group
is cut into fixed slices of time. Windows run inside (group, slice), and a summary with one row
per (group, slice) carries state across slices. The summary of the busiest group has at most one
row per slice of the time span, so it stays small even when that group holds most of the data.

Each function has two branches over its input, so put a table (`session.materialize`) between
chained calls. Each expects non-NULL keys, as validated events have them, and a slice number in
`slice_column` that never decreases along `order`.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickweave.functions.time import time_slice

SLICE = "_slice"
SLICE_SECONDS = 3600


def add_slice(
    rows: DataFrame, ts: str = "event_timestamp", seconds: int = SLICE_SECONDS
) -> DataFrame:
    return rows.withColumn(SLICE, time_slice(F.col(ts), seconds))


def _placed(rows: DataFrame, within: list[str]) -> DataFrame:
    """Rows that have a group and a time; stated here, the filter is the same in all branches."""
    return rows.filter(reduce(and_, [F.col(name).isNotNull() for name in within]))


def _carried(rows: DataFrame, summary: DataFrame, on: list[str]) -> DataFrame:
    """Bring the summary to the rows; every (group, slice) has one, and `rows` are split by it."""
    return rows.join(summary, on)


def previous_row(
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    values: list[str],
    slice_column: str = SLICE,
) -> DataFrame:
    """Add struct `previous` with `values` of the row before in the same group, NULL at the start."""
    within = [*keys, slice_column]
    rows = _placed(rows, within)
    here = Window.partitionBy(*within).orderBy(*order)
    across = Window.partitionBy(*keys).orderBy(slice_column)
    # The last row of each slice, taken in the same order and partitioning as the lags below: both
    # branches then share one scan and one shuffle if they use the same columns.
    carry = (
        rows.withColumn("following", F.lead(slice_column).over(here))
        .filter(F.col("following").isNull())
        .select(*within, F.struct(*values).alias("last"))
        .select(*within, F.lag("last").over(across).alias("carry"))
    )
    local = rows.withColumns(
        {
            "inside": F.lag(slice_column).over(here),
            **{f"before_{name}": F.lag(name).over(here) for name in values},
        }
    )
    before = F.struct(*[F.col(f"before_{name}").alias(name) for name in values])
    return (
        _carried(local, carry, within)
        .withColumn("previous", F.when(F.col("inside").isNotNull(), before).otherwise(F.col("carry")))
        .drop("carry", "inside", *[f"before_{name}" for name in values])
    )


def running_sum(
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    value: Column,
    name: str,
    slice_column: str = SLICE,
) -> DataFrame:
    """Add the sum of `value` over the group's rows up to and including this one."""
    within = [*keys, slice_column]
    rows = _placed(rows, within)
    before = (
        Window.partitionBy(*keys)
        .orderBy(slice_column)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carry = (
        rows.groupBy(*within)
        .agg(F.sum(value).alias("total"))
        .select(*within, F.sum("total").over(before).alias("carry"))
    )
    here = Window.partitionBy(*within).orderBy(*order)
    local = rows.withColumn("local", F.sum(value).over(here))
    return (
        _carried(local, carry, within)
        .withColumn(name, F.col("local") + F.coalesce("carry", F.lit(0)))
        .drop("local", "carry")
    )


def stack_depth(
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    step: str,
    slice_column: str = SLICE,
) -> DataFrame:
    """Add `depth_before` and `depth` of a stack where column `step` is +1 (push) or -1 (pop).

    Popping an empty stack does nothing, so the depth is the running sum less its running minimum
    (never above 0). Both carry across slices from the total and the minimum of each slice.
    """
    within = [*keys, slice_column]
    rows = _placed(rows, within)
    here = Window.partitionBy(*within).orderBy(*order)
    before = (
        Window.partitionBy(*keys)
        .orderBy(slice_column)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    none = F.lit(0)
    local = rows.withColumn("_sum", F.sum(step).over(here)).withColumn(
        "_low", F.min("_sum").over(here)
    )
    carry = (
        local.groupBy(*within)
        .agg(F.sum(step).alias("total"), F.min("_low").alias("low"))
        .withColumn("_start", F.coalesce(F.sum("total").over(before), none))
        .withColumn("_least", F.min(F.col("_start") + F.col("low")).over(before))
        .select(*within, "_start", F.least(F.coalesce("_least", none), none).alias("_floor"))
    )
    joined = _carried(local.withColumn("_low_before", F.lag("_low").over(here)), carry, within)
    total = F.col("_start") + F.col("_sum")

    def above_floor(height: Column, low: str) -> Column:
        return height - F.least("_floor", F.col("_start") + F.col(low))

    return joined.withColumns(
        {
            "depth": above_floor(total, "_low"),
            "depth_before": above_floor(total - F.col(step), "_low_before"),
        }
    ).drop("_sum", "_low", "_low_before", "_start", "_floor")
