"""Rollups over the gold tables and the health of all layers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.functions.measures import health_level, ratio, recency_level
from clickweave.functions.time import any_timestamp
from clickweave.sinks.lake import GOLD, on_date


def _total(name: str, default: float | int = 0) -> Column:
    return F.coalesce(F.sum(name), F.lit(default))


def live_metrics(funnel: DataFrame, today: str) -> DataFrame:
    """One row of today's figures; zeros when there is nothing yet.

    Users and sessions add up over windows, so whoever is active in two windows counts twice;
    `active_counts` counts them once.
    """
    counted = F.col("page_views") + F.col("product_views") + F.col("add_to_carts")
    return (
        funnel.filter(on_date(today))
        .agg(
            F.coalesce(F.sum(counted), F.lit(0)).alias("total_events"),
            _total("purchases").alias("total_purchases"),
            _total("unique_users").alias("active_users"),
            _total("sessions").alias("active_sessions"),
            _total("total_revenue", 0.0).alias("today_revenue"),
            F.coalesce(F.avg("events_per_second"), F.lit(0.0)).alias("events_per_second"),
            F.coalesce(F.max("conversion_rate"), F.lit(0.0)).alias("rate"),
        )
        .select(
            F.round("events_per_second", 2).alias("events_per_second"),
            "active_sessions",
            "active_users",
            F.round("today_revenue", 2).alias("today_revenue"),
            F.round(F.col("rate") * 100, 2).alias("today_conversion_rate"),
            "total_events",
            "total_purchases",
        )
    )


def active_counts(silver: DataFrame, today: str) -> DataFrame:
    """Users and sessions seen today, each once."""
    return silver.filter(on_date(today)).agg(
        F.countDistinct("user_id").alias("active_users"),
        F.countDistinct("session_id").alias("active_sessions"),
    )


FUNNEL_COLUMNS = [
    "window_start",
    "window_end",
    "page_views",
    "product_views",
    "add_to_carts",
    "checkout_starts",
    "purchases",
    "conversion_rate",
    "abandonment_rate",
    "avg_cart_value",
    "total_revenue",
]
SERIES_COLUMNS = ["window_start", "page_views", "add_to_carts", "purchases", "events_per_second"]
PRODUCT_COLUMNS = [
    "product_id",
    "category",
    "views",
    "add_to_carts",
    "purchases",
    "revenue",
    "conversion_rate",
]


def funnel_latest(funnel: DataFrame, limit: int = 100) -> DataFrame:
    return funnel.select(*FUNNEL_COLUMNS).orderBy(F.desc("window_start")).limit(limit)


def traffic_timeseries(funnel: DataFrame, limit: int = 200, latest: bool = False) -> DataFrame:
    """The oldest windows in time order, or with `latest` the newest ones."""
    order = F.desc("window_start") if latest else F.asc("window_start")
    rows = funnel.select(*SERIES_COLUMNS).orderBy(order).limit(limit)
    return rows.orderBy("window_start") if latest else rows


def _by(column: str) -> list[Column]:
    """Largest first with missing last; product and window break ties."""
    return [F.desc_nulls_last(column), F.asc("product_id"), F.asc("window_start")]


def top_products(products: DataFrame, limit: int = 10) -> DataFrame:
    """Rows of largest revenue; a product has one row per window and may appear repeatedly."""
    return products.orderBy(*_by("revenue")).limit(limit).select(*PRODUCT_COLUMNS)


def top_products_overall(products: DataFrame, limit: int = 10) -> DataFrame:
    """Products of largest revenue over all windows."""
    return (
        products.groupBy("product_id", "category")
        .agg(*[F.sum(name).alias(name) for name in ("views", "add_to_carts", "purchases", "revenue")])
        .withColumn("conversion_rate", ratio(F.col("purchases"), F.col("views")))
        .orderBy(F.desc_nulls_last("revenue"), "product_id", "category")
        .limit(limit)
        .select(*PRODUCT_COLUMNS)
    )


def top_converting_products(products: DataFrame, among: int = 20, limit: int = 10) -> DataFrame:
    """The best converting of the `among` rows with largest revenue, which a report shows.

    `top_converting_overall` ranks all rows.
    """
    return (
        products.orderBy(*_by("revenue"))
        .limit(among)
        .orderBy(F.desc("conversion_rate"), *_by("revenue"))
        .limit(limit)
        .select(*PRODUCT_COLUMNS)
    )


def top_converting_overall(products: DataFrame, limit: int = 10) -> DataFrame:
    """The best converting of all rows."""
    best = products.orderBy(F.desc("conversion_rate"), *_by("revenue")).limit(limit)
    return best.select(*PRODUCT_COLUMNS)


def _rollup(rows: DataFrame, dimension: str, sums: dict[str, str]) -> DataFrame:
    return (
        rows.filter(F.col(dimension).isNotNull())
        .groupBy(dimension)
        .agg(*[F.sum(source).alias(name) for name, source in sums.items()])
    )


def top_categories(products: DataFrame) -> DataFrame:
    sums = {
        "total_views": "views",
        "total_carts": "add_to_carts",
        "total_purchases": "purchases",
        "total_revenue": "revenue",
    }
    return (
        _rollup(products, "category", sums)
        .withColumn("conversion_rate", ratio(F.col("total_purchases"), F.col("total_views")))
        .orderBy(F.desc_nulls_last("total_revenue"), "category")
    )


_VISITS = {"total_visits": "visits", "total_users": "users", "total_purchases": "purchases"}
_VISITS_AND_MONEY = {**_VISITS, "total_revenue": "revenue"}


def geography(traffic: DataFrame) -> DataFrame:
    rows = _rollup(traffic, "country", _VISITS_AND_MONEY)
    return rows.orderBy(F.desc("total_visits"), "country")


def traffic_sources(traffic: DataFrame) -> DataFrame:
    rows = _rollup(traffic, "traffic_source", _VISITS_AND_MONEY)
    percent = ratio(F.col("total_purchases"), F.col("total_visits")) * 100
    return rows.withColumn("conversion_rate_pct", percent).orderBy(
        F.desc("total_visits"), "traffic_source"
    )


def device_breakdown(traffic: DataFrame) -> DataFrame:
    return _rollup(traffic, "device", _VISITS).orderBy(F.desc("total_visits"), "device")


# Which column tells how fresh a layer is.
FRESHNESS = {"bronze": "event_time", "silver": "event_time", "funnel_metrics": "window_end"}


def layer_health(layers: dict[str, DataFrame]) -> DataFrame:
    """Rows and latest timestamp of every layer, one row each."""

    def one(name: str, rows: DataFrame) -> DataFrame:
        fresh = F.max(FRESHNESS[name]) if name in FRESHNESS else F.lit(None).cast("string")
        eps = (
            F.max("events_per_second") if name == "funnel_metrics" else F.lit(None).cast("double")
        )
        return rows.agg(
            F.count(F.lit(1)).alias("rows"), fresh.alias("latest"), eps.alias("peak_eps")
        ).select(F.lit(name).alias("layer"), "rows", "latest", "peak_eps")

    return reduce(DataFrame.unionByName, [one(name, rows) for name, rows in layers.items()])


def pipeline_health(layers: dict[str, DataFrame]) -> DataFrame:
    """One row for all layers: counts, peak rate, freshness and lake totals."""

    def of(layer: str, column: str) -> Column:
        return F.max(F.when(F.col("layer") == layer, F.col(column)))

    counts = {
        "bronze_count": "bronze",
        "silver_count": "silver",
        "gold_funnel_count": "funnel_metrics",
        "gold_product_count": "product_performance",
        "gold_traffic_count": "traffic_analytics",
        "dead_letter_count": "dead_letter",
    }
    row = layer_health(layers).agg(
        *[F.coalesce(of(layer, "rows"), F.lit(0)).alias(name) for name, layer in counts.items()],
        F.round(F.coalesce(of("funnel_metrics", "peak_eps"), F.lit(0.0)), 2).alias(
            "events_per_second"
        ),
        of("bronze", "latest").alias("latest_bronze_ts"),
        of("silver", "latest").alias("latest_silver_ts"),
        F.coalesce(of("funnel_metrics", "latest"), F.lit("")).alias("latest_gold_ts"),
    )
    stored = F.col("bronze_count") + F.col("silver_count") + F.col("gold_funnel_count")
    gold = F.col("gold_funnel_count") + F.col("gold_product_count") + F.col("gold_traffic_count")
    return row.withColumns({"events_in_lake": stored, "gold_rows": gold})


def layer_levels(health: DataFrame, as_of: Column) -> DataFrame:
    """Grade layers: rows present, data recent, and events arriving.

    Dead letters are the exception: having none is green.
    """
    present = F.when(F.col("rows") > 0, "green").otherwise("yellow")
    absent = F.when(F.col("rows") == 0, "green").otherwise("yellow")
    latest = F.col("latest")
    return health.select(
        "layer",
        "rows",
        F.when(F.col("layer") == "dead_letter", absent).otherwise(present).alias("count_level"),
        F.when(
            F.col("layer").isin(list(FRESHNESS)), recency_level(latest, any_timestamp(latest), as_of)
        ).alias("recency_level"),
        F.when(F.col("layer") == GOLD[0], health_level(F.coalesce("peak_eps", F.lit(0.0)), 1.0)).alias(
            "rate_level"
        ),
    )
