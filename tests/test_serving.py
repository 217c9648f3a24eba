from pyspark.sql import functions as F

from clickweave import schemas
from clickweave.plans import layers, reports, serving
from tests.helpers import event, events_df, rows_of, silver_df

ROWS = [
    event("1", 0),
    event("2", 1, event_type="product_view", product_id="p1", category="books"),
    event("3", 2, event_type="add_to_cart", product_id="p1", category="books", cart_value=30.0),
    event("4", 3, event_type="purchase", product_id="p1", category="books", cart_value=30.0),
    event("5", 300, event_type="product_view", product_id="p2", category="toys", country="France"),
    event("6", 301, event_type="purchase", product_id="p2", category="toys", cart_value=90.0,
          country="France"),
    event("7", 86_400, event_type="purchase", product_id="p1", category="books", cart_value=1.0),
    event("8", 86_401, event_type="add_to_cart", product_id="p3", category=None),
]


def _gold(spark):
    return layers.gold_tables(silver_df(spark, ROWS))


def _empty(spark, table):
    return spark.createDataFrame([], schemas.TABLES[table])


def test_live_metrics_of_a_day(spark):
    row = serving.live_metrics(_gold(spark)["funnel_metrics"], "2024-03-01").first()
    assert row.asDict() == {
        "events_per_second": 0.01,
        "active_sessions": 2,
        "active_users": 2,
        "today_revenue": 120.0,
        "today_conversion_rate": 100.0,
        "total_events": 4,
        "total_purchases": 2,
    }
    assert rows_of(serving.active_counts(silver_df(spark, ROWS), "2024-03-01")) == [(1, 1)]


def test_live_metrics_are_zero_without_data(spark):
    row = serving.live_metrics(_empty(spark, "funnel_metrics"), "2024-03-01").first()
    assert set(row.asDict().values()) == {0}


def test_empty_tables_give_empty_results(spark):
    products, traffic = _empty(spark, "product_performance"), _empty(spark, "traffic_analytics")
    funnel = _empty(spark, "funnel_metrics")
    for rows in (
        serving.top_products(products),
        serving.top_categories(products),
        serving.geography(traffic),
        serving.traffic_sources(traffic),
        serving.device_breakdown(traffic),
        serving.funnel_latest(funnel),
        serving.traffic_timeseries(funnel),
        reports.latest_window(funnel),
        reports.metric_trends(funnel),
    ):
        assert rows.count() == 0


def test_top_products_rank_windows_or_products(spark):
    products = _gold(spark)["product_performance"]
    per_window = [(r.product_id, r.revenue) for r in serving.top_products(products).collect()]
    assert per_window == [("p2", 90.0), ("p1", 30.0), ("p1", 1.0), ("p3", None)]
    overall = serving.top_products_overall(products, 2).collect()
    assert [(r.product_id, r.revenue) for r in overall] == [("p2", 90.0), ("p1", 31.0)]
    converting = serving.top_converting_products(products, among=2, limit=1).collect()
    assert [r.product_id for r in converting] == ["p2"]


def test_rollups_skip_missing_dimensions_and_are_sorted(spark):
    gold = _gold(spark)
    categories = serving.top_categories(gold["product_performance"]).collect()
    assert [(r.category, r.total_views, r.conversion_rate) for r in categories] == [
        ("toys", 1, 1.0),
        ("books", 1, 2.0),
    ]
    places = serving.geography(gold["traffic_analytics"]).collect()
    assert [(r.country, r.total_visits, r.total_revenue) for r in places] == [
        ("Germany", 6, 31.0),
        ("France", 2, 90.0),
    ]
    (source,) = serving.traffic_sources(gold["traffic_analytics"]).collect()
    assert (source.total_visits, source.conversion_rate_pct) == (8, 37.5)
    assert rows_of(serving.device_breakdown(gold["traffic_analytics"])) == [("tablet", 8, 3, 3)]


def test_series_and_latest(spark):
    funnel = _gold(spark)["funnel_metrics"]
    newest = serving.funnel_latest(funnel, 1).first()
    assert newest.window_start == "2024-03-02 10:00:00" and len(newest) == 11
    oldest = [r.window_start[8:16] for r in serving.traffic_timeseries(funnel, 2).collect()]
    latest = [r.window_start[8:16] for r in serving.traffic_timeseries(funnel, 2, True).collect()]
    assert oldest == ["01 10:00", "01 10:05"] and latest == ["01 10:05", "02 10:00"]
    assert [r.window_start[8:16] for r in reports.sparkline(funnel, 2).collect()] == latest


def test_health_of_all_layers(spark):
    silver = silver_df(spark, ROWS)
    tables = {"bronze": layers.bronze_rows(events_df(spark, ROWS)), "silver": silver, **_gold(spark)}
    tables["dead_letter"] = _empty(spark, "dead_letter")
    row = serving.pipeline_health(tables).first()
    assert (row.bronze_count, row.silver_count, row.dead_letter_count) == (8, 8, 0)
    counts = row.gold_funnel_count, row.gold_product_count, row.gold_traffic_count
    assert counts == (3, 4, 3) and row.gold_rows == 10 and row.events_in_lake == 19
    assert row.latest_gold_ts == "2024-03-02 10:05:00" and row.events_per_second == 0.01
    as_of = F.lit("2024-03-02 10:06:00").cast("timestamp")
    levels = serving.layer_levels(serving.layer_health(tables), as_of)
    assert {r.layer: tuple(r)[2:] for r in levels.collect()} == {
        "bronze": ("green", "yellow", None),
        "silver": ("green", "yellow", None),
        "funnel_metrics": ("green", "green", "yellow"),
        "product_performance": ("green", None, None),
        "traffic_analytics": ("green", None, None),
        "dead_letter": ("green", None, None),
    }


def test_health_of_nothing(spark):
    row = serving.pipeline_health({n: _empty(spark, n) for n in schemas.TABLES}).first()
    assert row.bronze_count == 0 and row.latest_bronze_ts is None and row.latest_gold_ts == ""


def test_trend_crosses_days(spark):
    trend = reports.metric_trends(_gold(spark)["funnel_metrics"], ["purchases"]).orderBy("window_start")
    assert [(r.current, r.previous, r.trend) for r in trend.collect()] == [
        (1, None, "flat"),
        (1, 1, "flat"),
        (1, 1, "flat"),
    ]
    trend = reports.metric_trends(_gold(spark)["funnel_metrics"], ["total_revenue"])
    assert [r.trend for r in trend.orderBy("window_start").collect()] == ["flat", "up", "down"]


def test_stages_shares_and_bands(spark):
    gold = _gold(spark)
    first = gold["funnel_metrics"].filter("window_start like '%03-01 10:00%'")
    stages = reports.funnel_stages(first).orderBy("position").collect()
    assert [(s.stage, s.events, s.percent_of_first) for s in stages] == [
        ("Page Views", 1, 100.0),
        ("Product Views", 1, 100.0),
        ("Add to Cart", 1, 100.0),
        ("Checkout", 0, 0.0),
        ("Purchases", 1, 100.0),
    ]
    shares = reports.share_of_total(
        serving.geography(gold["traffic_analytics"]), "country", "total_visits"
    )
    assert rows_of(shares, "country", "share") == [("France", 0.25), ("Germany", 0.75)]
    assert rows_of(reports.conversion_bands(gold["funnel_metrics"])) == [("0-5", 1), ("20+", 2)]
