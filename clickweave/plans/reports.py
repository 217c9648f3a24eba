"""Figures derived for reading: trends, stages, shares and bands."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.functions import measures
from clickweave.operators import ordered

STAGES = {
    "Page Views": "page_views",
    "Product Views": "product_views",
    "Add to Cart": "add_to_carts",
    "Checkout": "checkout_starts",
    "Purchases": "purchases",
}
KPIS = ["events_per_second", "sessions", "unique_users", "total_revenue"]
DAY_SECONDS = 86_400


def latest_window(funnel: DataFrame) -> DataFrame:
    return funnel.orderBy(F.desc("window_start")).limit(1)


def sparkline(funnel: DataFrame, points: int = 30) -> DataFrame:
    """Event rate of the newest windows, in time order."""
    newest = (
        funnel.select("window_start", "events_per_second")
        .orderBy(F.desc("window_start"))
        .limit(points)
    )
    return newest.orderBy("window_start")


def metric_trends(
    funnel: DataFrame, metrics: list[str] = KPIS, inverse_good: bool = False
) -> DataFrame:
    """Every window's metrics with the window before it and the direction of change.

    Windows are ordered within days, and only one row per day is ordered across days.
    """
    entries = F.array(
        *[
            F.struct(F.lit(name).alias("metric"), F.col(name).cast("double").alias("current"))
            for name in metrics
        ]
    )
    rows = funnel.select("window_start", F.inline(entries))
    sliced = ordered.add_slice(
        rows.withColumn("at", F.col("window_start").cast("timestamp")), "at", DAY_SECONDS
    )
    return ordered.previous_row(sliced, ["metric"], ["window_start"], ["current"]).select(
        "window_start",
        "metric",
        "current",
        F.col("previous.current").alias("previous"),
        measures.trend(F.col("current"), F.col("previous.current"), inverse_good).alias("trend"),
    )


def funnel_stages(window: DataFrame) -> DataFrame:
    """The five stages of each window given, with their percentage of the first."""
    first = next(iter(STAGES.values()))
    stages = F.array(
        *[
            F.struct(
                F.lit(position).alias("position"),
                F.lit(label).alias("stage"),
                F.col(column).alias("events"),
            )
            for position, (label, column) in enumerate(STAGES.items(), 1)
        ]
    )
    return window.select("window_start", F.col(first).alias("first"), F.inline(stages)).select(
        "window_start",
        "position",
        "stage",
        "events",
        (measures.ratio(F.col("events"), F.col("first")) * 100).alias("percent_of_first"),
    )


def share_of_total(rows: DataFrame, dimension: str, measure: str) -> DataFrame:
    """Each row's part of the whole; the whole is a scalar subquery, not a one-task window."""
    total = rows.select(F.sum(measure)).scalar()
    return rows.select(
        dimension, measure, measures.ratio(F.col(measure), total).alias("share")
    )


def conversion_bands(funnel: DataFrame) -> DataFrame:
    """Number of windows in each conversion band."""
    percent = F.col("conversion_rate") * 100
    return funnel.groupBy(measures.conversion_band(percent).alias("band")).agg(
        F.count(F.lit(1)).alias("windows")
    )
