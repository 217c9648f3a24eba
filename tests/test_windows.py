import pytest
from pyspark.sql import functions as F

from clickweave import schemas
from clickweave.operators import windows
from tests.helpers import event, rows_of, same, silver_df

JOURNEY = [
    event("1", 0),
    event("2", 10, event_type="product_view", product_id="p1", category="books"),
    event("3", 20, event_type="add_to_cart", product_id="p1", category="books", cart_value=30.0),
    event("4", 30, event_type="add_to_cart", product_id="p2", category="toys", cart_value=50.0),
    event("5", 40, event_type="begin_checkout"),
    event("6", 50, event_type="payment"),
    event("7", 60, event_type="purchase", product_id="p1", category="books", cart_value=80.0),
    event("8", 70, user_id="u2", session_id="s2", device="desktop"),
    event("9", 80, user_id="u2", session_id="s3", device="desktop"),
    event("10", 300, user_id="u2", session_id="s3", device="desktop"),
]


def test_funnel_by_hand(spark):
    funnel = windows.funnel_metrics(silver_df(spark, JOURNEY))
    assert funnel.columns == schemas.FUNNEL.fieldNames()
    first, second = funnel.orderBy("window_start").collect()
    assert (first.window_start, first.window_end) == ("2024-03-01 10:00:00", "2024-03-01 10:05:00")
    counts = first.page_views, first.product_views, first.add_to_carts, first.checkout_starts
    assert counts == (3, 1, 2, 2)
    assert (first.purchases, first.sessions, first.unique_users) == (1, 3, 2)
    assert (first.avg_cart_value, first.total_revenue) == (40.0, 80.0)
    assert (first.conversion_rate, first.abandonment_rate) == (0.5, 0.5)
    assert first.events_per_second == 6 / 300
    assert (first.year, first.month, first.day, first.hour) == (2024, 3, 1, 10)
    assert second.window_start == "2024-03-01 10:05:00" and second.page_views == 1
    assert (second.avg_cart_value, second.total_revenue) == (None, None)
    assert (second.conversion_rate, second.abandonment_rate) == (0.0, 0.0)


def test_rates_may_leave_zero_to_one(spark):
    rows = [event("a", event_type="purchase"), event("b", event_type="purchase")]
    rows += [event("c", event_type="payment"), event("d", event_type="add_to_cart")]
    (row,) = windows.funnel_metrics(silver_df(spark, rows)).collect()
    assert (row.conversion_rate, row.abandonment_rate) == (2.0, -1.0)


def test_sliding_windows_overlap(spark):
    funnel = windows.funnel_metrics(silver_df(spark, JOURNEY), "10 minutes", "5 minutes")
    starts = [(r.window_start[11:16], r.page_views) for r in funnel.orderBy("window_start").collect()]
    assert starts == [("09:55", 3), ("10:00", 4), ("10:05", 1)]
    assert funnel.filter("window_start like '%10:00:00'").first().events_per_second == 7 / 600


def test_long_windows_give_one_row_each(spark):
    rows = [event("a", 0), event("b", 3600), event("c", 5000)]
    funnel = windows.funnel_metrics(silver_df(spark, rows), "90 minutes")
    assert rows_of(funnel, "window_start", "page_views") == [
        ("2024-03-01 09:00:00", 1),
        ("2024-03-01 10:30:00", 2),
    ]


def test_product_performance_by_hand(spark):
    products = windows.product_performance(silver_df(spark, JOURNEY))
    assert products.columns == schemas.PRODUCTS.fieldNames()
    assert rows_of(
        products, "product_id", "category", "views", "add_to_carts", "purchases", "revenue",
        "conversion_rate",
    ) == [("p1", "books", 1, 1, 1, 80.0, 1.0), ("p2", "toys", 0, 1, 0, None, 0.0)]


def test_traffic_by_hand(spark):
    traffic = windows.traffic_analytics(silver_df(spark, JOURNEY))
    assert traffic.columns == schemas.TRAFFIC.fieldNames()
    assert rows_of(
        traffic, "window_start", "device", "visits", "users", "purchases", "revenue",
        "conversion_rate",
    ) == [
        ("2024-03-01 10:00:00", "desktop", 2, 1, 0, None, 0.0),
        ("2024-03-01 10:00:00", "tablet", 7, 1, 1, 80.0, 1 / 7),
        ("2024-03-01 10:05:00", "desktop", 1, 1, 0, None, 0.0),
    ]


def test_traffic_keeps_missing_dimensions_and_ignores_missing_users(spark):
    rows = [event("a", country=None, user_id=None), event("b", country=None)]
    assert rows_of(
        windows.traffic_analytics(silver_df(spark, rows)), "country", "visits", "users"
    ) == [(None, 2, 1)]


@pytest.mark.parametrize("slide", [None, "5 minutes"])
def test_chained_aggregation_equals_count_distinct(spark, slide):
    rows = [
        event(str(i), i * 7, user_id=f"u{i % 5}", session_id=f"s{i % 11}" if i % 13 else None,
              event_type=schemas.EVENT_TYPES[i % 10], cart_value=float(i))
        for i in range(300)
    ]
    silver = silver_df(spark, rows)
    args = ("10 minutes", slide) if slide else ("5 minutes",)
    assert same(windows.funnel_metrics(silver, *args), windows.funnel_metrics_exact(silver, *args))


def test_approximate_counts_are_close(spark):
    rows = [event(str(i), 0, user_id=f"u{i}", session_id=f"s{i // 2}") for i in range(1000)]
    (row,) = windows.funnel_metrics_approx(silver_df(spark, rows)).collect()
    assert abs(row.unique_users - 1000) < 60 and abs(row.sessions - 500) < 30


def test_window_counts_add_up_to_the_input(spark):
    silver = silver_df(spark, JOURNEY)
    total = windows.traffic_analytics(silver).agg(F.sum("visits")).first()[0]
    assert total == silver.count()
