"""Table schemas, value domains and rule tables.

Every schema is built from a fresh field list, so extending one never changes another.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The event domain.
EVENT_TYPES = [
    "page_view",
    "search",
    "category_view",
    "product_view",
    "add_to_cart",
    "remove_from_cart",
    "begin_checkout",
    "payment",
    "purchase",
    "logout",
]
CHECKOUT_TYPES = ["begin_checkout", "payment", "purchase"]
CHECKOUT_START_TYPES = ["begin_checkout", "payment"]
PRODUCT_VIEW_TYPES = ["product_view", "page_view"]

# Legal next steps within a session; logout ends it.
TRANSITIONS = {
    "page_view": ["search", "category_view", "product_view", "page_view"],
    "search": ["product_view", "category_view", "page_view"],
    "category_view": ["product_view", "search", "page_view"],
    "product_view": ["add_to_cart", "product_view", "category_view", "page_view"],
    "add_to_cart": ["product_view", "remove_from_cart", "begin_checkout", "page_view"],
    "remove_from_cart": ["product_view", "add_to_cart", "begin_checkout", "page_view"],
    "begin_checkout": ["payment", "page_view", "add_to_cart"],
    "payment": ["purchase", "page_view"],
    "purchase": ["logout", "page_view"],
    "logout": [],
}

# Which operating systems, campaigns and pages go with which device, source and type.
DEVICE_SYSTEMS = {
    "mobile": ["iOS", "Android"],
    "desktop": ["Windows", "macOS", "Linux"],
    "tablet": ["iOS", "Android"],
}
SOURCE_CAMPAIGNS = {
    "direct": ["organic", "direct"],
    "organic_search": ["organic_seo", "brand_search", "generic_search"],
    "paid_search": ["google_ads", "bing_ads", "shopping_campaign"],
    "social_media": ["instagram_campaign", "facebook_ads", "tiktok_promo", "twitter_ad"],
    "email": ["newsletter", "promo_email", "abandoned_cart", "welcome_series"],
    "referral": ["blog_referral", "partner_link", "review_site"],
}
TYPE_PAGES = {
    "page_view": ["/", "/products", "/categories", "/sale", "/new-arrivals", "/deals"],
    "search": ["/search"],
    "category_view": [
        "/category/electronics",
        "/category/clothing",
        "/category/home_garden",
        "/category/sports",
        "/category/books",
    ],
    "product_view": ["/product/"],
    "add_to_cart": ["/product/"],
    "remove_from_cart": ["/cart"],
    "begin_checkout": ["/checkout"],
    "payment": ["/checkout/payment"],
    "purchase": ["/checkout/confirmation"],
    "logout": ["/logout"],
}

# Categories, places and devices.
CATEGORIES = [
    "electronics",
    "clothing",
    "home_garden",
    "books",
    "sports",
    "beauty",
    "toys",
    "groceries",
    "automotive",
    "office",
]
PLACES = [
    ("United States", "New York"),
    ("United States", "San Francisco"),
    ("United States", "Chicago"),
    ("United Kingdom", "London"),
    ("Germany", "Berlin"),
    ("France", "Paris"),
    ("Canada", "Toronto"),
    ("Australia", "Sydney"),
    ("India", "Mumbai"),
    ("Brazil", "São Paulo"),
    ("Japan", "Tokyo"),
]
DEVICES = ["mobile", "desktop", "tablet"]
BROWSERS = ["Chrome", "Safari", "Firefox", "Edge"]
EXPERIMENT_GROUPS = ["control", "variant_a", "variant_b"]
REFERRERS = ["google.com", "facebook.com", "direct", "email.com", "twitter.com"]

PARTITION_COLUMNS = ["year", "month", "day", "hour"]
BATCH_COLUMN = "batch_id"


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_S, _D, _I, _L, _B, _TS = (
    T.StringType(),
    T.DoubleType(),
    T.IntegerType(),
    T.LongType(),
    T.BooleanType(),
    T.TimestampType(),
)


def _event_fields() -> dict[str, T.DataType]:
    return dict(
        event_id=_S,
        event_time=_S,
        user_id=_S,
        session_id=_S,
        event_type=_S,
        page=_S,
        product_id=_S,
        category=_S,
        device=_S,
        browser=_S,
        operating_system=_S,
        country=_S,
        city=_S,
        traffic_source=_S,
        campaign=_S,
        referrer=_S,
        price=_D,
        quantity=_I,
        cart_value=_D,
        currency=_S,
        experiment_group=_S,
        is_logged_in=_B,
    )


def _hour_fields() -> dict[str, T.DataType]:
    return dict(year=_I, month=_I, day=_I, hour=_I)


METADATA = _struct(session_depth=_I, page_load_time_ms=_I, viewport_width=_I)

EVENT = _struct(**_event_fields())
EVENT_WITH_METADATA = _struct(**_event_fields(), metadata=METADATA)

HEADERS = T.ArrayType(
    T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType())])
)
MESSAGE = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

BRONZE = _struct(
    **_event_fields(), event_timestamp=_TS, ingestion_timestamp=_S, **_hour_fields()
)
SILVER = _struct(
    **_event_fields(),
    event_timestamp=_TS,
    event_date=T.DateType(),
    event_hour=_I,
    is_purchase=_B,
    is_cart_add=_B,
    is_page_view=_B,
    is_checkout=_B,
    is_bounce=_B,
    ingestion_timestamp=_S,
    **_hour_fields(),
)
FUNNEL = _struct(
    window_start=_S,
    window_end=_S,
    page_views=_L,
    product_views=_L,
    add_to_carts=_L,
    checkout_starts=_L,
    purchases=_L,
    sessions=_L,
    unique_users=_L,
    avg_cart_value=_D,
    total_revenue=_D,
    conversion_rate=_D,
    abandonment_rate=_D,
    events_per_second=_D,
    **_hour_fields(),
)
PRODUCTS = _struct(
    window_start=_S,
    window_end=_S,
    product_id=_S,
    category=_S,
    views=_L,
    add_to_carts=_L,
    purchases=_L,
    revenue=_D,
    conversion_rate=_D,
    **_hour_fields(),
)
TRAFFIC = _struct(
    window_start=_S,
    window_end=_S,
    country=_S,
    traffic_source=_S,
    device=_S,
    visits=_L,
    users=_L,
    purchases=_L,
    revenue=_D,
    conversion_rate=_D,
    **_hour_fields(),
)
DEAD_LETTER = _struct(
    raw_key=_S,
    raw_value=_S,
    kafka_topic=_S,
    kafka_partition=_I,
    kafka_offset=_L,
    failure_reason=_S,
    failure_timestamp=_S,
    **_hour_fields(),
)

# Silver columns and why the event is listed: `delayed` (it counts in gold nevertheless), or `late`
# (its window was closed, and no gold row counts it).
LATE = _struct(
    **{f.name: f.dataType for f in SILVER if f.name not in _hour_fields()},
    late_reason=_S,
    **_hour_fields(),
)

TABLES = {
    "bronze": BRONZE,
    "silver": SILVER,
    "funnel_metrics": FUNNEL,
    "product_performance": PRODUCTS,
    "traffic_analytics": TRAFFIC,
    "dead_letter": DEAD_LETTER,
    "late_events": LATE,
}

# What batches add to the windows of each metrics table; see operators.windows for the measures.
_BOUNDS = dict(window_start=_TS, window_end=_TS)
PARTS = {
    "funnel_metrics": _struct(
        **_BOUNDS,
        kind=_S,
        id=_S,
        page_views=_L,
        product_views=_L,
        add_to_carts=_L,
        checkout_starts=_L,
        purchases=_L,
        cart_sum=_D,
        cart_count=_L,
        revenue=_D,
        **_hour_fields(),
    ),
    "product_performance": _struct(
        **_BOUNDS,
        product_id=_S,
        category=_S,
        views=_L,
        add_to_carts=_L,
        purchases=_L,
        revenue=_D,
        **_hour_fields(),
    ),
    "traffic_analytics": _struct(
        **_BOUNDS,
        country=_S,
        traffic_source=_S,
        device=_S,
        user_id=_S,
        visits=_L,
        purchases=_L,
        revenue=_D,
        **_hour_fields(),
    ),
}
# What batches add to their sessions; see operators.sessions.
SESSION_PARTS = _struct(
    session_id=_S,
    kind=_S,
    id=_S,
    first_at=_TS,
    last_at=_TS,
    events=_L,
    searches=_L,
    purchases=_L,
    place=_L,
    event_id=_S,
    **_hour_fields(),
)
# The time before which windows are closed, as UTC text.
SETTLED = _struct(settled_before=_S, **_hour_fields())
