"""Windowed metrics: funnel, product and traffic.

The same functions serve batches and streams. On a batch `countDistinct` is planned as a shuffle
on (window, id), so one busy window spreads over all tasks. Streams refuse it; there the exact
form chains two aggregations (append mode) and the approximate one keeps a sketch per window.

Partition columns come from the window start after aggregation, which keeps them out of the
shuffle key and gives one row per window whatever its length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave import schemas
from clickweave.functions.measures import count_of, ratio
from clickweave.functions.time import hour_columns

EVENT_TIME = "event_timestamp"
COUNTERS = {
    "page_views": ["page_view"],
    "product_views": ["product_view"],
    "add_to_carts": ["add_to_cart"],
    "checkout_starts": schemas.CHECKOUT_START_TYPES,
    "purchases": ["purchase"],
}


def _window(duration: str, slide: str | None = None) -> Column:
    return F.window(EVENT_TIME, duration, slide or duration).alias("window")


def _seconds(duration: str) -> Column:
    """Length of a window as seconds, folded to a constant by the optimizer."""
    interval = F.expr(f"interval '{duration}'")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp")
    return F.unix_seconds(epoch + interval) - F.unix_seconds(epoch)


def _of_type(kind: str, value: str) -> Column:
    return F.when(F.col("event_type") == kind, F.col(value))


def _stamp(rows: DataFrame) -> DataFrame:
    """Replace the window struct by text bounds and lake partition columns."""
    start, end = F.col("window.start"), F.col("window.end")
    return rows.withColumns(
        {
            "window_start": start.cast("string"),
            "window_end": end.cast("string"),
            **hour_columns(start),
        }
    ).drop("window")


def _finish(rows: DataFrame, schema) -> DataFrame:
    return _stamp(rows).select(*schema.fieldNames())


def _funnel_rates(rows: DataFrame, duration: str | None) -> DataFrame:
    """Add the rates; without a duration the bounds of each window give it."""
    left = F.col("checkout_starts") > 0
    start, end = F.unix_seconds(F.col("window.start")), F.unix_seconds(F.col("window.end"))
    seconds = end - start if duration is None else _seconds(duration)
    counted = F.col("page_views") + F.col("product_views") + F.col("add_to_carts")
    return _finish(
        rows.withColumns(
            {
                "conversion_rate": ratio(F.col("purchases"), F.col("add_to_carts")),
                "abandonment_rate": F.when(
                    left, 1.0 - F.col("purchases") / F.col("checkout_starts")
                ).otherwise(0.0),
                "events_per_second": counted / seconds,
            }
        ),
        schemas.FUNNEL,
    )


def _funnel_measures() -> list[Column]:
    return [
        *[count_of(F.col("event_type"), *types).alias(name) for name, types in COUNTERS.items()],
        F.avg(_of_type("add_to_cart", "cart_value")).alias("avg_cart_value"),
        F.sum(_of_type("purchase", "cart_value")).alias("total_revenue"),
    ]


def funnel_metrics(
    events: DataFrame, window: str = "5 minutes", slide: str | None = None
) -> DataFrame:
    """Batch: funnel counts, distinct sessions and users, money and rates per window."""
    rows = events.groupBy(_window(window, slide)).agg(
        *_funnel_measures(),
        F.countDistinct("session_id").alias("sessions"),
        F.countDistinct("user_id").alias("unique_users"),
    )
    return _funnel_rates(rows, window)


FUNNEL_SUMS = [*COUNTERS, "cart_sum", "cart_count", "revenue"]


def funnel_parts(
    events: DataFrame, window: str = "5 minutes", slide: str | None = None
) -> DataFrame:
    """What one set of events adds to its windows: sums in a row of kind `event`, and a row for each
    distinct session and user. Parts of several sets add up by window, kind and id.
    """
    entry = F.explode(
        F.array(
            F.struct(F.lit("event").alias("kind"), F.lit(None).cast("string").alias("id")),
            F.struct(F.lit("session").alias("kind"), F.col("session_id").alias("id")),
            F.struct(F.lit("user").alias("kind"), F.col("user_id").alias("id")),
        )
    )
    is_event = F.col("entry.kind") == "event"
    cart_add = _of_type("add_to_cart", "cart_value")
    kind = F.when(is_event, F.col("event_type"))
    return (
        events.select(EVENT_TIME, "event_type", "cart_value", entry.alias("entry"))
        .filter(is_event | F.col("entry.id").isNotNull())
        .groupBy(
            _window(window, slide),
            F.col("entry.kind").alias("kind"),
            F.col("entry.id").alias("id"),
        )
        .agg(
            *[count_of(kind, *types).alias(name) for name, types in COUNTERS.items()],
            F.sum(F.when(is_event, cart_add)).alias("cart_sum"),
            F.count(F.when(is_event, cart_add)).alias("cart_count"),
            F.sum(F.when(is_event, _of_type("purchase", "cart_value"))).alias("revenue"),
        )
    )


def _funnel_of_parts(parts: DataFrame, window: str | None = None) -> DataFrame:
    """Funnel rows of parts that have each window, kind and id once."""
    rows = (
        parts.groupBy("window")
        .agg(
            *[F.sum(name).alias(name) for name in COUNTERS],
            F.count_if(F.col("kind") == "session").alias("sessions"),
            F.count_if(F.col("kind") == "user").alias("unique_users"),
            F.sum("cart_sum").alias("cart_sum"),
            F.sum("cart_count").alias("cart_count"),
            F.sum("revenue").alias("total_revenue"),
        )
        .withColumn(
            "avg_cart_value",
            F.when(F.col("cart_count") > 0, F.col("cart_sum") / F.col("cart_count")),
        )
    )
    return _funnel_rates(rows, window)


def funnel_metrics_exact(
    events: DataFrame, window: str = "5 minutes", slide: str | None = None
) -> DataFrame:
    """Stream, append mode: exact distinct counts from two chained aggregations.

    Each event becomes a measure row, a session row and a user row; the first aggregation keeps
    one row per (window, kind, id), spreading a busy window over all partitions, and the second
    adds them up.
    """
    return _funnel_of_parts(funnel_parts(events, window, slide), window)


def funnel_metrics_panes(
    events: DataFrame, window: str = "10 minutes", slide: str = "5 minutes"
) -> DataFrame:
    """Sliding windows put together from panes of `slide`; batch, or stream in append mode.

    Events are aggregated once, into panes. Only the panes' rows, one per kind and id, are copied
    into the windows that overlap, not the events. `window` is a multiple of `slide`.
    """
    panes = funnel_parts(events, slide)
    pane_time = F.window_time(F.col("window"))
    placed = panes.select(pane_time.alias("pane_time"), "kind", "id", *FUNNEL_SUMS)
    wide = F.window("pane_time", window, slide).alias("window")
    parts = placed.groupBy(wide, "kind", "id").agg(*[F.sum(n).alias(n) for n in FUNNEL_SUMS])
    return _funnel_of_parts(parts, window)


def funnel_metrics_approx(
    events: DataFrame,
    window: str = "5 minutes",
    slide: str | None = None,
    error: float = 0.02,
) -> DataFrame:
    """Stream, any output mode: distinct counts from a fixed-size sketch per window."""
    rows = events.groupBy(_window(window, slide)).agg(
        *_funnel_measures(),
        F.approx_count_distinct("session_id", error).alias("sessions"),
        F.approx_count_distinct("user_id", error).alias("unique_users"),
    )
    return _funnel_rates(rows, window)


PRODUCT_SUMS = ["views", "add_to_carts", "purchases", "revenue"]
TRAFFIC_KEYS = ["country", "traffic_source", "device"]
TRAFFIC_SUMS = ["visits", "purchases", "revenue"]


def product_parts(events: DataFrame, window: str = "5 minutes") -> DataFrame:
    """What one set of events adds to its windows and products."""
    kind = F.col("event_type")
    return (
        events.filter(F.col("product_id").isNotNull())
        .groupBy(_window(window), "product_id", "category")
        .agg(
            count_of(kind, *schemas.PRODUCT_VIEW_TYPES).alias("views"),
            count_of(kind, "add_to_cart").alias("add_to_carts"),
            count_of(kind, "purchase").alias("purchases"),
            F.sum(_of_type("purchase", "cart_value")).alias("revenue"),
        )
    )


def _product_of_parts(parts: DataFrame) -> DataFrame:
    rate = ratio(F.col("purchases"), F.col("views"))
    return _finish(parts.withColumn("conversion_rate", rate), schemas.PRODUCTS)


def product_performance(events: DataFrame, window: str = "5 minutes") -> DataFrame:
    """Views, cart adds, purchases, revenue and conversion per window and product."""
    return _product_of_parts(product_parts(events, window))


def traffic_parts(events: DataFrame, window: str = "5 minutes") -> DataFrame:
    """What each user of one set of events adds to the windows, countries, sources and devices."""
    return events.groupBy(_window(window), *TRAFFIC_KEYS, "user_id").agg(
        F.count(F.lit(1)).alias("visits"),
        count_of(F.col("event_type"), "purchase").alias("purchases"),
        F.sum(_of_type("purchase", "cart_value")).alias("revenue"),
    )


def _traffic_of_parts(parts: DataFrame) -> DataFrame:
    """Traffic rows of parts that have each user once per window and group."""
    rows = (
        parts.groupBy("window", *TRAFFIC_KEYS)
        .agg(
            F.sum("visits").alias("visits"),
            F.count("user_id").alias("users"),
            F.sum("purchases").alias("purchases"),
            F.sum("revenue").alias("revenue"),
        )
        .withColumn("conversion_rate", ratio(F.col("purchases"), F.col("visits")))
    )
    return _finish(rows, schemas.TRAFFIC)


def traffic_analytics(events: DataFrame, window: str = "5 minutes") -> DataFrame:
    """Visits, distinct users, purchases and revenue per window, country, source and device.

    Both steps are plain aggregations, so the same exact plan runs on streams in append mode: the
    first works per user, which also splits a busy group over all tasks.
    """
    return _traffic_of_parts(traffic_parts(events, window))


def all_parts(events: DataFrame, window: str = "5 minutes") -> dict[str, DataFrame]:
    """The parts of every metrics table."""
    return {
        "funnel_metrics": funnel_parts(events, window),
        "product_performance": product_parts(events, window),
        "traffic_analytics": traffic_parts(events, window),
    }


def merged_parts(table: str, parts: DataFrame) -> DataFrame:
    """The metrics of a table from the parts of any number of event sets that share no event.

    Sums and distinct ids of a window add up whatever set they came in, so the result equals the
    metrics of all events together.
    """
    keys, sums, finish = {
        "funnel_metrics": (["kind", "id"], FUNNEL_SUMS, _funnel_of_parts),
        "product_performance": (["product_id", "category"], PRODUCT_SUMS, _product_of_parts),
        "traffic_analytics": ([*TRAFFIC_KEYS, "user_id"], TRAFFIC_SUMS, _traffic_of_parts),
    }[table]
    once = parts.groupBy("window", *keys).agg(*[F.sum(name).alias(name) for name in sums])
    return finish(once)
