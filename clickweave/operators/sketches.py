"""Mergeable sketches per window: distinct sessions and users, and the products of most events.

A state has a fixed size whatever the traffic, and states of short windows add up to any longer span
without the events. Distinct counts come with a relative standard error of 1.04 / 2^(log_size / 2);
a product's count is exact while a span has fewer products than are tracked, and else off by at most
3.5 / tracked of all events counted; products that bound could hide are not listed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.operators.windows import EVENT_TIME

LOG_SIZE = 14
TRACKED = 1000


def distinct_error(log_size: int = LOG_SIZE) -> float:
    """Relative standard error of a distinct count."""
    return 1.04 / 2 ** (log_size / 2)


def distinct_states(
    events: DataFrame, window: str = "1 hour", log_size: int = LOG_SIZE
) -> DataFrame:
    """Events and the states of distinct sessions and users per window; batch or stream, any mode."""
    return events.groupBy(F.window(EVENT_TIME, window).alias("window")).agg(
        F.count(F.lit(1)).alias("events"),
        F.hll_sketch_agg("session_id", log_size).alias("session_state"),
        F.hll_sketch_agg("user_id", log_size).alias("user_state"),
    )


def distinct_over(states: DataFrame, span: str) -> DataFrame:
    """Events and estimated distinct sessions and users per `span`, a multiple of the states' window."""
    place = F.window(F.col("window.start"), span).alias("window")
    return states.groupBy(place).agg(
        F.sum("events").alias("events"),
        F.hll_sketch_estimate(F.hll_union_agg("session_state")).alias("sessions"),
        F.hll_sketch_estimate(F.hll_union_agg("user_state")).alias("users"),
    )


def product_states(events: DataFrame, window: str = "1 hour", tracked: int = TRACKED) -> DataFrame:
    """The state of the products of most events per window."""
    with_product = events.filter(F.col("product_id").isNotNull())
    state = F.expr(f"approx_top_k_accumulate(product_id, {tracked})")
    return with_product.groupBy(F.window(EVENT_TIME, window).alias("window")).agg(
        state.alias("product_state")
    )


def top_products_over(states: DataFrame, limit: int = 20, tracked: int = TRACKED) -> DataFrame:
    """The products of most events over all the given states, ties by product.

    All tracked products are estimated and then ranked, so that ties at the limit are settled alike.
    """
    combined = f"approx_top_k_estimate(approx_top_k_combine(product_state, {tracked}), {tracked})"
    # Grouped by a constant, as combining the states of an empty table fails.
    whole = states.groupBy(F.lit(0).alias("whole")).agg(F.expr(combined).alias("found"))
    rows = whole.select(F.explode("found").alias("f"))
    ranked = rows.select(F.col("f.item").alias("product_id"), F.col("f.count").alias("events"))
    return ranked.orderBy(F.desc("events"), "product_id").limit(limit)
