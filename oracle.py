"""The catalog's queries as plain SQL for DuckDB, written independently of the package."""

from __future__ import annotations

# Fixed values, stated here a second time so that a wrong table in the package shows.
FIELDS = [
    "event_id", "event_time", "user_id", "session_id", "event_type", "page", "product_id",
    "category", "device", "browser", "operating_system", "country", "city", "traffic_source",
    "campaign", "referrer", "price", "quantity", "cart_value", "currency", "experiment_group",
    "is_logged_in",
]
EVENT_TYPES = [
    "page_view", "search", "category_view", "product_view", "add_to_cart", "remove_from_cart",
    "begin_checkout", "payment", "purchase", "logout",
]
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
        "/category/electronics", "/category/clothing", "/category/home_garden", "/category/sports",
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
CATEGORIES = [
    "electronics", "clothing", "home_garden", "books", "sports", "beauty", "toys", "groceries",
    "automotive", "office",
]
PLACES = [
    ("United States", "New York"), ("United States", "San Francisco"), ("United States", "Chicago"),
    ("United Kingdom", "London"), ("Germany", "Berlin"), ("France", "Paris"), ("Canada", "Toronto"),
    ("Australia", "Sydney"), ("India", "Mumbai"), ("Brazil", "São Paulo"), ("Japan", "Tokyo"),
]
DEVICES = ["mobile", "desktop", "tablet"]
BROWSERS = ["Chrome", "Safari", "Firefox", "Edge"]
EXPERIMENT_GROUPS = ["control", "variant_a", "variant_b"]
REFERRERS = ["google.com", "facebook.com", "direct", "email.com", "twitter.com"]
TIME_PARTS = ["year", "month", "day", "hour"]
# How the activity log becomes events; inclusive ranges of k have a delivery fault.
ACTIVITY_TYPES = {
    "view": ["page_view", "product_view"],
    "click": ["search", "category_view", "add_to_cart", "remove_from_cart", "begin_checkout"],
    "signup": ["payment", "logout"],
    "purchase": ["purchase"],
}
ABOUT_PRODUCTS = ["product_view", "add_to_cart", "remove_from_cart", "purchase"]
LOG_PAGES = {
    "page_view": ["/", "/products", "/categories", "/sale", "/new-arrivals", "/deals"],
    "search": ["/search"],
    "category_view": [
        "/category/electronics", "/category/clothing", "/category/home_garden", "/category/books",
        "/category/sports", "/category/beauty", "/category/toys", "/category/groceries",
        "/category/automotive", "/category/office",
    ],
    "product_view": ["/product/"],
    "add_to_cart": ["/product/"],
    "remove_from_cart": ["/cart"],
    "begin_checkout": ["/checkout"],
    "payment": ["/checkout/payment"],
    "purchase": ["/checkout/confirmation"],
    "logout": ["/logout"],
}
DELIVERED_TWICE = (50, 54)
TEN_DAYS_OLD = (60, 61)
THREE_HOURS_OLD = (62, 63)
NEGATIVE_CART = (70, 74)
MISSING_PRICE = (80, 84)
ABSURD_QUANTITY = (85, 87)
UNTERMINATED = (90, 91)
EMPTY_ID = (92, 93)
# Messages held back until the last of three deliveries.
HELD_BACK = (40, 41)


def _list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _in_list(values: list[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _at(values: list[str], index: str) -> str:
    return f"({_list(values)})[CAST(({index}) % {len(values)} AS INTEGER) + 1]"


def _between(bounds: tuple[int, int]) -> str:
    return f"k BETWEEN {bounds[0]} AND {bounds[1]}"


COLUMNS = ", ".join(FIELDS)
TYPES = _in_list(EVENT_TYPES)
CAMPAIGNS = [c for group in SOURCE_CAMPAIGNS.values() for c in group]
PAGE_CASES = " ".join(
    f"WHEN '{kind}' THEN {_at(pages, 'k')}" for kind, pages in LOG_PAGES.items()
)
ACTIVITY_CASES = " ".join(
    f"WHEN '{name}' THEN {_at(types, 'k')}" for name, types in ACTIVITY_TYPES.items()
)
PRODUCT_TYPES = _in_list(ABOUT_PRODUCTS)

SHAPED = f"""
log AS (
  SELECT event_id AS n, ts, user_id AS u, event_type AS activity, value,
         CAST(json_extract(props, '$.k') AS INTEGER) AS k
  FROM events
),
typed AS (
  SELECT *, CASE activity {ACTIVITY_CASES} ELSE activity END AS kind FROM log
),
shaped AS (
  SELECT n, u, k, ts, value, kind AS event_type,
    printf('user_%06d', u) AS user_id,
    'sess_' || CAST(u AS VARCHAR) || '_' || strftime(ts, '%Y%m%d') AS session_id,
    CASE kind {PAGE_CASES} ELSE '/' END AS page,
    CASE WHEN kind IN {PRODUCT_TYPES}
         THEN 'prod_' || lpad(CAST(k % 50 AS VARCHAR), 3, '0') END AS product_id,
    CASE WHEN kind IN {PRODUCT_TYPES} OR kind = 'category_view'
         THEN {_at(CATEGORIES, 'k')} END AS category,
    {_at(DEVICES, 'u')} AS device,
    {_at(BROWSERS, 'u')} AS browser,
    {_at(['iOS', 'Android', 'Windows', 'macOS', 'Linux'], 'u')} AS operating_system,
    {_at([c for c, _ in PLACES], 'u')} AS country,
    {_at([c for _, c in PLACES], 'u')} AS city,
    {_at(list(SOURCE_CAMPAIGNS), 'u')} AS traffic_source,
    {_at(CAMPAIGNS, 'k')} AS campaign,
    {_at(REFERRERS, 'k')} AS referrer,
    CASE WHEN kind = 'remove_from_cart' THEN -1 ELSE k % 4 END AS quantity,
    'USD' AS currency,
    {_at(EXPERIMENT_GROUPS, 'u')} AS experiment_group,
    u % 2 = 0 AS is_logged_in
  FROM typed
)"""

# Clean events; `happened_at` is the event time cut to seconds.
EVENTS = f"""{SHAPED},
ev AS (
  SELECT CAST(n AS VARCHAR) AS event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS event_time,
         value AS price, value AS cart_value, date_trunc('second', ts) AS happened_at, * EXCLUDE (n, value)
  FROM shaped
),
good AS (SELECT * FROM ev WHERE event_type IN {TYPES})"""

# Delivered messages with their faults.
DELIVERED = f"""{SHAPED},
copies AS (
  SELECT *, 0 AS copy FROM shaped
  UNION ALL SELECT *, 1 FROM shaped WHERE {_between(DELIVERED_TWICE)}
),
stated AS (
  SELECT *, CASE WHEN {_between(TEN_DAYS_OLD)} THEN ts - INTERVAL 10 DAY
                 WHEN {_between(THREE_HOURS_OLD)} THEN ts - INTERVAL 3 HOUR
                 ELSE ts END AS happened,
         ts + INTERVAL 2 SECOND AS arrived, n * 2 + copy AS kafka_offset,
         CAST(u % 6 AS INTEGER) AS kafka_partition
  FROM copies
),
message AS (
  SELECT CASE WHEN {_between(EMPTY_ID)} THEN '' ELSE CAST(n AS VARCHAR) END AS event_id,
         strftime(happened, '%Y-%m-%dT%H:%M:%S.%fZ') AS event_time,
         date_trunc('second', happened) AS happened_at,
         CASE WHEN {_between(MISSING_PRICE)} THEN NULL ELSE value END AS price,
         CASE WHEN {_between(NEGATIVE_CART)} THEN 0 - value ELSE value END AS cart_value,
         CASE WHEN {_between(ABSURD_QUANTITY)} THEN -200 ELSE quantity END AS quantity,
         {_between(UNTERMINATED)} AS unterminated, * EXCLUDE (n, value, quantity, happened)
  FROM stated
),
parsed AS (SELECT * FROM message WHERE NOT unterminated),
valid AS (SELECT * FROM parsed WHERE event_id <> '' AND event_type IN {TYPES}),
raw_message AS (
  SELECT *, '{{"event_id":"' || event_id || '","event_time":"' || event_time || '"' AS raw_value
  FROM message WHERE unterminated
),
in_range AS (
  SELECT * FROM valid WHERE happened_at BETWEEN arrived - INTERVAL 7 DAY AND arrived + INTERVAL 1 DAY
),
clean AS (
  SELECT * REPLACE (
    CASE WHEN price IS NULL OR price < 0 THEN 0.0 ELSE price END AS price,
    CASE WHEN quantity < -100 THEN 0 ELSE quantity END AS quantity,
    CASE WHEN cart_value < 0 THEN 0.0 ELSE cart_value END AS cart_value)
  FROM in_range
),
silver AS (SELECT DISTINCT * EXCLUDE (copy, kafka_offset) FROM clean)"""


def _hour_columns(ts: str) -> str:
    parts = [f"CAST(EXTRACT({p} FROM {ts}) AS INTEGER) AS {p}" for p in TIME_PARTS]
    return ", ".join(parts)


def _sum(condition: str, value: str = "cart_value") -> str:
    return f"sum({value}) FILTER ({condition})"


def _rates(source: str, seconds: int, finish: str = "") -> str:
    return f"""
  SELECT CAST(w AS VARCHAR) AS window_start,
    CAST(w + INTERVAL {seconds} SECOND AS VARCHAR) AS window_end,
    page_views, product_views, add_to_carts, checkout_starts, purchases, sessions, unique_users,
    avg_cart_value, total_revenue,
    CASE WHEN add_to_carts > 0 THEN purchases / add_to_carts ELSE 0.0 END AS conversion_rate,
    CASE WHEN checkout_starts > 0 THEN 1.0 - purchases / checkout_starts ELSE 0.0 END
      AS abandonment_rate,
    (page_views + product_views + add_to_carts) / {float(seconds)} AS events_per_second,
    {_hour_columns('w')}
  FROM {source} {finish}"""


def _funnel(events: str, window: str = "time_bucket(INTERVAL 5 MINUTE, happened_at)") -> str:
    return f"""
  SELECT {window} AS w,
    count(*) FILTER (event_type = 'page_view') AS page_views,
    count(*) FILTER (event_type = 'product_view') AS product_views,
    count(*) FILTER (event_type = 'add_to_cart') AS add_to_carts,
    count(*) FILTER (event_type IN ('begin_checkout', 'payment')) AS checkout_starts,
    count(*) FILTER (event_type = 'purchase') AS purchases,
    count(DISTINCT session_id) AS sessions, count(DISTINCT user_id) AS unique_users,
    avg(cart_value) FILTER (event_type = 'add_to_cart') AS avg_cart_value,
    {_sum("event_type = 'purchase'")} AS total_revenue
  FROM {events} GROUP BY 1"""


def _products(events: str) -> str:
    return f"""
  SELECT CAST(w AS VARCHAR) AS window_start, CAST(w + INTERVAL 5 MINUTE AS VARCHAR) AS window_end,
    product_id, category, views, add_to_carts, purchases, revenue,
    CASE WHEN views > 0 THEN purchases / views ELSE 0.0 END AS conversion_rate,
    {_hour_columns('w')}
  FROM (
    SELECT time_bucket(INTERVAL 5 MINUTE, happened_at) AS w, product_id, category,
      count(*) FILTER (event_type IN ('product_view', 'page_view')) AS views,
      count(*) FILTER (event_type = 'add_to_cart') AS add_to_carts,
      count(*) FILTER (event_type = 'purchase') AS purchases,
      {_sum("event_type = 'purchase'")} AS revenue
    FROM {events} WHERE product_id IS NOT NULL GROUP BY 1, 2, 3)"""


def _traffic(events: str) -> str:
    return f"""
  SELECT CAST(w AS VARCHAR) AS window_start, CAST(w + INTERVAL 5 MINUTE AS VARCHAR) AS window_end,
    country, traffic_source, device, visits, users, purchases, revenue,
    CASE WHEN visits > 0 THEN purchases / visits ELSE 0.0 END AS conversion_rate,
    {_hour_columns('w')}
  FROM (
    SELECT time_bucket(INTERVAL 5 MINUTE, happened_at) AS w, country, traffic_source, device,
      count(*) AS visits, count(DISTINCT user_id) AS users,
      count(*) FILTER (event_type = 'purchase') AS purchases,
      {_sum("event_type = 'purchase'")} AS revenue
    FROM {events} GROUP BY 1, 2, 3, 4)"""


def _gold(events: str) -> str:
    return f"""windows AS ({_funnel(events)}),
funnel AS ({_rates('windows', 300)}),
products AS ({_products(events)}),
traffic AS ({_traffic(events)})"""


GOLD = f"{EVENTS},\n{_gold('good')}"
LAYERS = f"{DELIVERED},\n{_gold('silver')}"

ROUNDED_FUNNEL = """* REPLACE (round(avg_cart_value, 6) AS avg_cart_value,
  round(total_revenue, 6) AS total_revenue, round(conversion_rate, 6) AS conversion_rate,
  round(abandonment_rate, 6) AS abandonment_rate, round(events_per_second, 6) AS events_per_second)"""
ROUNDED_REVENUE = """* REPLACE (round(revenue, 6) AS revenue,
  round(conversion_rate, 6) AS conversion_rate)"""

LAYER_ROWS = """
  SELECT 'bronze' AS layer, count(*) AS rows, max(event_time) AS latest,
         CAST(NULL AS DOUBLE) AS peak_eps FROM valid
  UNION ALL SELECT 'silver', count(*), max(event_time), NULL FROM silver
  UNION ALL SELECT 'funnel_metrics', count(*), max(window_end),
         round(max(events_per_second), 6) FROM funnel
  UNION ALL SELECT 'product_performance', count(*), NULL, NULL FROM products
  UNION ALL SELECT 'traffic_analytics', count(*), NULL, NULL FROM traffic
"""
PARSE_FAILURES = "UNION ALL SELECT 'dead_letter', count(*), NULL, NULL FROM message WHERE unterminated"

REASON = f"""CASE WHEN unterminated THEN 'failed_parse' WHEN event_id = '' THEN 'missing_required'
  WHEN event_type NOT IN {TYPES} THEN 'invalid_event_type'
  WHEN NOT happened_at BETWEEN arrived - INTERVAL 7 DAY AND arrived + INTERVAL 1 DAY
  THEN 'out_of_range' END"""

FLAGS = """event_type = 'purchase' AS is_purchase, event_type = 'add_to_cart' AS is_cart_add,
  event_type = 'page_view' AS is_page_view,
  event_type IN ('begin_checkout', 'payment', 'purchase') AS is_checkout, FALSE AS is_bounce"""

STEPS = f"""{EVENTS},
steps AS (
  SELECT session_id, happened_at, event_id, event_type AS to_type,
         lag(event_type) OVER (PARTITION BY session_id ORDER BY event_time, event_id) AS from_type
  FROM good
)"""

ALLOWED = ", ".join(f"('{a}', '{b}')" for a, next_ in TRANSITIONS.items() for b in next_)


def _pairs(table: dict[str, list[str]]) -> str:
    return ", ".join(f"('{a}', '{b}')" for a, values in table.items() for b in values)


def _violations(rule: str, left: str, right: str, table: dict[str, list[str]]) -> str:
    return f"""SELECT '{rule}' AS rule, {left} AS left_value, {right} AS right_value,
  count(*) AS events FROM good WHERE ({left}, {right}) NOT IN ({_pairs(table)}) GROUP BY 2, 3"""


DAY_15 = "year = 2024 AND month = 1 AND day = 15"
SECONDS_TEXT = "%Y-%m-%d %H:%M:%S.%f"
TRENDS = """CASE WHEN current IS NULL OR previous IS NULL OR previous = 0 THEN 'flat'
  WHEN abs((current - previous) / previous) < 0.01 THEN 'flat'
  WHEN (current - previous) / previous > 0 THEN 'up' ELSE 'down' END"""

GAP_SESSIONS = f"""
marked AS (
  SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts)
                                <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS starts
  FROM events
),
numbered AS (
  SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY ts
                              ROWS UNBOUNDED PRECEDING) AS session FROM marked
),
spans AS (
  SELECT user_id, min(ts) AS first_at, max(ts) AS last_at, count(*) AS events
  FROM numbered GROUP BY user_id, session
)
SELECT user_id, strftime(first_at, '{SECONDS_TEXT}') AS session_start,
       strftime(last_at, '{SECONDS_TEXT}') AS session_end, events
FROM spans"""



def closed(condition: str = "") -> str:
    """The time by which a window must have ended: the delay before the newest event kept."""
    return f"(SELECT max(happened_at) FROM good {condition}) - INTERVAL 60 MINUTE"



CART = f"""{EVENTS},
cart AS (
  SELECT session_id, happened_at, event_id, event_type, price * quantity AS worth, quantity AS pieces,
         CASE WHEN event_type = 'remove_from_cart' THEN -1 ELSE 1 END AS step,
         row_number() OVER (PARTITION BY session_id ORDER BY event_time, event_id) AS i
  FROM good WHERE event_type IN ('add_to_cart', 'purchase', 'remove_from_cart')
),
walked AS (
  SELECT session_id, i, 1 AS seen, CASE WHEN step > 0 THEN [i] ELSE [] END AS stack,
         CASE WHEN step > 0 THEN i END AS added, CAST(NULL AS BIGINT) AS removed
  FROM cart WHERE i = 1
  UNION ALL
  SELECT c.session_id, c.i, 1,
         CASE WHEN c.step > 0 THEN list_append(w.stack, c.i)
              WHEN len(w.stack) > 0 THEN w.stack[1:len(w.stack) - 1] ELSE w.stack END,
         CASE WHEN c.step > 0 THEN c.i END,
         CASE WHEN c.step < 0 THEN w.stack[len(w.stack)] END
  FROM walked w JOIN cart c ON c.session_id = w.session_id AND c.i = w.i + 1
),
changed AS (
  SELECT c.session_id, c.happened_at, c.event_id, c.event_type, c.i, len(w.stack) AS items,
         CASE WHEN c.step > 0 THEN c.worth ELSE coalesce(0.0 - r.worth, 0.0) END AS amount,
         CASE WHEN c.step > 0 THEN c.pieces ELSE coalesce(-r.pieces, 0) END AS quantity
  FROM walked w JOIN cart c USING (session_id, i)
  LEFT JOIN cart r ON r.session_id = w.session_id AND r.i = w.removed
)"""


# The estimates are bounded, not stated: three standard errors around the exact counts.
DISTINCT_BY_DAY = """SELECT strftime(happened_at, '%Y-%m-%d') AS day, count(*) AS events,
  count(DISTINCT session_id) AS sessions, count(DISTINCT user_id) AS users,
  TRUE AS sessions_close, TRUE AS users_close FROM good GROUP BY 1"""


def statements() -> dict[str, str]:
    sql = {
        "decode_json_messages": f"WITH {DELIVERED} SELECT {COLUMNS} FROM parsed",
        "split_invalid_messages": f"""WITH {DELIVERED}
SELECT event_id AS raw_key, raw_value, kafka_partition, kafka_offset FROM raw_message""",
        # The payload of each event by its id modulo 9; the values follow from the rules of decoding.
        "payload_edges": """
SELECT event_id AS kafka_offset, event_id % 9 >= 4 AS parsed,
  CASE WHEN event_id % 9 = 6 THEN '' WHEN event_id % 9 >= 4 THEN CAST(event_id AS VARCHAR) END AS event_id,
  CASE event_id % 9 WHEN 6 THEN 2.5 WHEN 8 THEN 1.5 WHEN 4 THEN 0.0 WHEN 5 THEN 0.0 WHEN 7 THEN 0.0 END
    AS price,
  CASE event_id % 9 WHEN 6 THEN 3 WHEN 4 THEN 0 WHEN 5 THEN 0 WHEN 7 THEN 0 WHEN 8 THEN 0 END AS quantity,
  CASE WHEN event_id % 9 = 8 THEN event_id END AS new_field
FROM events""",
        "message_counts": f"""WITH {DELIVERED}
SELECT count(*) AS total, count(*) FILTER (NOT unterminated) AS valid,
       count(*) FILTER (unterminated) AS invalid FROM message""",
        "parse_event_time": f"""WITH {EVENTS}
SELECT event_id, event_time, CAST(happened_at AS VARCHAR) AS event_timestamp FROM ev""",
        "partition_columns": f"WITH {EVENTS} SELECT event_id, {_hour_columns('happened_at')} FROM ev",
        "date_columns": f"""WITH {EVENTS}
SELECT event_id, CAST(CAST(happened_at AS DATE) AS VARCHAR) AS event_date,
       CAST(EXTRACT(hour FROM happened_at) AS INTEGER) AS event_hour FROM ev""",
        "event_flags": f"WITH {EVENTS} SELECT event_id, {FLAGS} FROM ev",
        "clean_measures": f"""WITH {DELIVERED}
SELECT event_id, event_time,
  CASE WHEN price IS NULL OR price < 0 THEN 0.0 ELSE price END AS price,
  CASE WHEN quantity IS NULL OR quantity < -100 THEN 0 ELSE quantity END AS quantity,
  CASE WHEN cart_value IS NULL OR cart_value < 0 THEN 0.0 ELSE cart_value END AS cart_value
FROM parsed""",
        "time_range_filter": f"""WITH {EVENTS}
SELECT event_id, CAST(happened_at AS VARCHAR) AS event_timestamp FROM ev
WHERE happened_at BETWEEN TIMESTAMP '2024-01-13 00:00:00' AND TIMESTAMP '2024-01-21 00:00:00'""",
        "validate_valid": f"WITH {DELIVERED} SELECT {COLUMNS} FROM valid",
        "validate_invalid": f"""WITH {DELIVERED}
SELECT {COLUMNS} FROM parsed EXCEPT SELECT {COLUMNS} FROM valid""",
        "strict_validate": f"""WITH {DELIVERED}
SELECT event_id, event_time, event_id <> '' AND event_type IN {TYPES} AS is_strictly_valid
FROM parsed""",
        "dedup_events": f"WITH {DELIVERED} SELECT DISTINCT {COLUMNS} FROM valid",
        "dead_letter_rows": f"""WITH {DELIVERED}
SELECT event_id AS raw_key, raw_value, 'clickstream-events' AS kafka_topic, kafka_partition,
  kafka_offset, 'failed_parse' AS failure_reason,
  CAST(date_trunc('second', arrived) AS VARCHAR) AS failure_timestamp, {_hour_columns('arrived')}
FROM raw_message""",
        "failure_reasons": f"""WITH {DELIVERED},
reasons AS (SELECT kafka_offset, {REASON} AS failure_reason FROM message)
SELECT * FROM reasons WHERE failure_reason IS NOT NULL""",
        "late_events": f"""WITH {DELIVERED}
SELECT event_id, CAST(happened_at AS VARCHAR) AS event_timestamp FROM valid
WHERE happened_at < arrived - INTERVAL 60 MINUTE""",
        "bronze_table": f"""WITH {DELIVERED}
SELECT {COLUMNS}, CAST(happened_at AS VARCHAR) AS event_timestamp,
  CAST(date_trunc('second', arrived) AS VARCHAR) AS ingestion_timestamp, {_hour_columns('happened_at')}
FROM valid""",
        "silver_table": f"""WITH {DELIVERED}
SELECT {COLUMNS}, CAST(happened_at AS VARCHAR) AS event_timestamp,
  CAST(CAST(happened_at AS DATE) AS VARCHAR) AS event_date,
  CAST(EXTRACT(hour FROM happened_at) AS INTEGER) AS event_hour, {FLAGS}, {_hour_columns('happened_at')},
  CAST(date_trunc('second', arrived) AS VARCHAR) AS ingestion_timestamp
FROM silver""",
        "funnel_tumbling": f"WITH {GOLD} SELECT {ROUNDED_FUNNEL} FROM funnel",
        "funnel_sliding": f"""WITH {EVENTS},
twice AS (
  SELECT *, time_bucket(INTERVAL 5 MINUTE, happened_at) AS slot FROM good
  UNION ALL SELECT *, time_bucket(INTERVAL 5 MINUTE, happened_at) - INTERVAL 5 MINUTE FROM good
),
windows AS ({_funnel('twice', 'slot')}),
funnel AS ({_rates('windows', 600)})
SELECT {ROUNDED_FUNNEL} FROM funnel""",
        "product_performance": f"WITH {GOLD} SELECT {ROUNDED_REVENUE} FROM products",
        "traffic_analytics": f"WITH {GOLD} SELECT {ROUNDED_REVENUE} FROM traffic",
        "top_viewed_products": f"""WITH {EVENTS}
SELECT product_id, count(*) AS events FROM good WHERE product_id IS NOT NULL
GROUP BY product_id ORDER BY events DESC, product_id LIMIT 20""",
        "distinct_estimates": f"WITH {EVENTS} {DISTINCT_BY_DAY}",
        "stream_distinct": f"WITH {EVENTS} {DISTINCT_BY_DAY}",
        "live_metrics": f"""WITH {GOLD}
SELECT round(coalesce(avg(events_per_second), 0), 2) AS events_per_second,
  CAST(coalesce(sum(sessions), 0) AS BIGINT) AS active_sessions,
  CAST(coalesce(sum(unique_users), 0) AS BIGINT) AS active_users,
  round(coalesce(sum(total_revenue), 0), 2) AS today_revenue,
  round(coalesce(max(conversion_rate), 0) * 100, 2) AS today_conversion_rate,
  CAST(coalesce(sum(page_views + product_views + add_to_carts), 0) AS BIGINT) AS total_events,
  CAST(coalesce(sum(purchases), 0) AS BIGINT) AS total_purchases
FROM funnel WHERE {DAY_15}""",
        "active_counts": f"""WITH {EVENTS}
SELECT count(DISTINCT user_id) AS active_users, count(DISTINCT session_id) AS active_sessions
FROM good WHERE CAST(happened_at AS DATE) = DATE '2024-01-15'""",
        "top_categories": f"""WITH {GOLD}
SELECT category, CAST(sum(views) AS BIGINT) AS total_views,
  CAST(sum(add_to_carts) AS BIGINT) AS total_carts,
  CAST(sum(purchases) AS BIGINT) AS total_purchases, round(sum(revenue), 6) AS total_revenue,
  round(CASE WHEN sum(views) > 0 THEN sum(purchases) / sum(views) ELSE 0.0 END, 6)
    AS conversion_rate
FROM products WHERE category IS NOT NULL GROUP BY category""",
        "geography": f"""WITH {GOLD}
SELECT country, CAST(sum(visits) AS BIGINT) AS total_visits,
  CAST(sum(users) AS BIGINT) AS total_users, CAST(sum(purchases) AS BIGINT) AS total_purchases,
  round(sum(revenue), 6) AS total_revenue
FROM traffic WHERE country IS NOT NULL GROUP BY country""",
        "traffic_sources": f"""WITH {GOLD}
SELECT traffic_source, CAST(sum(visits) AS BIGINT) AS total_visits,
  CAST(sum(users) AS BIGINT) AS total_users, CAST(sum(purchases) AS BIGINT) AS total_purchases,
  round(sum(revenue), 6) AS total_revenue,
  round(CASE WHEN sum(visits) > 0 THEN sum(purchases) / sum(visits) * 100 ELSE 0.0 END, 6)
    AS conversion_rate_pct
FROM traffic WHERE traffic_source IS NOT NULL GROUP BY traffic_source""",
        "device_breakdown": f"""WITH {GOLD}
SELECT device, CAST(sum(visits) AS BIGINT) AS total_visits,
  CAST(sum(users) AS BIGINT) AS total_users, CAST(sum(purchases) AS BIGINT) AS total_purchases
FROM traffic WHERE device IS NOT NULL GROUP BY device""",
        "funnel_latest": f"""WITH {GOLD}
SELECT {ROUNDED_FUNNEL} FROM (
  SELECT * EXCLUDE (sessions, unique_users, events_per_second, year, month, day, hour),
  FROM funnel ORDER BY window_start DESC LIMIT 100)""".replace(
            ", round(events_per_second, 6) AS events_per_second", ""
        ),
        "traffic_timeseries": f"""WITH {GOLD}
SELECT window_start, page_views, add_to_carts, purchases,
  round(events_per_second, 6) AS events_per_second
FROM funnel ORDER BY window_start LIMIT 200""",
        "traffic_timeseries_latest": f"""WITH {GOLD}
SELECT window_start, page_views, add_to_carts, purchases,
  round(events_per_second, 6) AS events_per_second
FROM funnel ORDER BY window_start DESC LIMIT 200""",
        "top_products": f"""WITH {GOLD}
SELECT product_id, category, views, add_to_carts, purchases, round(revenue, 6) AS revenue,
  round(conversion_rate, 6) AS conversion_rate
FROM products ORDER BY revenue DESC NULLS LAST, product_id, window_start LIMIT 10""",
        "top_products_overall": f"""WITH {GOLD}
SELECT product_id, category, CAST(sum(views) AS BIGINT) AS views,
  CAST(sum(add_to_carts) AS BIGINT) AS add_to_carts, CAST(sum(purchases) AS BIGINT) AS purchases,
  round(sum(revenue), 6) AS revenue,
  round(CASE WHEN sum(views) > 0 THEN sum(purchases) / sum(views) ELSE 0.0 END, 6)
    AS conversion_rate
FROM products GROUP BY product_id, category
ORDER BY sum(revenue) DESC NULLS LAST, product_id, category LIMIT 10""",
        "top_converting_products": f"""WITH {GOLD},
best AS (SELECT * FROM products
         ORDER BY revenue DESC NULLS LAST, product_id, window_start LIMIT 20)
SELECT product_id, category, views, add_to_carts, purchases, round(revenue, 6) AS revenue,
  round(conversion_rate, 6) AS conversion_rate
FROM best ORDER BY conversion_rate DESC, revenue DESC NULLS LAST, product_id, window_start
LIMIT 10""",
        "top_converting_overall": f"""WITH {GOLD}
SELECT product_id, category, views, add_to_carts, purchases, round(revenue, 6) AS revenue,
  round(conversion_rate, 6) AS conversion_rate
FROM products ORDER BY conversion_rate DESC, revenue DESC NULLS LAST, product_id, window_start
LIMIT 10""",
        "layer_health": f"WITH {LAYERS} {LAYER_ROWS} {PARSE_FAILURES}",
        "lake_summary": f"""WITH {LAYERS},
counts AS (SELECT
  (SELECT count(*) FROM valid) AS bronze_count, (SELECT count(*) FROM silver) AS silver_count,
  (SELECT count(*) FROM funnel) AS gold_funnel_count,
  (SELECT count(*) FROM products) AS gold_product_count,
  (SELECT count(*) FROM traffic) AS gold_traffic_count,
  (SELECT count(*) FROM message WHERE unterminated) AS dead_letter_count)
SELECT *, (SELECT round(max(events_per_second), 2) FROM funnel) AS events_per_second,
  (SELECT max(event_time) FROM valid) AS latest_bronze_ts,
  (SELECT max(event_time) FROM silver) AS latest_silver_ts,
  (SELECT max(window_end) FROM funnel) AS latest_gold_ts,
  bronze_count + silver_count + gold_funnel_count AS events_in_lake,
  gold_funnel_count + gold_product_count + gold_traffic_count AS gold_rows
FROM counts""",
        "recency_levels": f"""WITH {LAYERS}, health AS ({LAYER_ROWS} {PARSE_FAILURES}),
aged AS (
  SELECT *, date_diff('second', date_trunc('second', CAST(replace(replace(latest, 'T', ' '),
    'Z', '') AS TIMESTAMP)), TIMESTAMP '2024-01-31 00:05:00') AS age FROM health)
SELECT layer, rows,
  CASE WHEN (layer = 'dead_letter') = (rows = 0) THEN 'green' ELSE 'yellow' END AS count_level,
  CASE WHEN layer IN ('bronze', 'silver', 'funnel_metrics') THEN
    CASE WHEN latest IS NULL THEN 'red' WHEN age < 300 THEN 'green' WHEN age < 900 THEN 'yellow'
         ELSE 'red' END END AS recency_level,
  CASE WHEN layer = 'funnel_metrics' THEN
    CASE WHEN peak_eps <= 0 THEN 'red' WHEN peak_eps < 1.0 THEN 'yellow' ELSE 'green' END
    END AS rate_level
FROM aged""",
        "trend": f"""WITH {GOLD},
kpis AS ("""
        + " UNION ALL ".join(
            f"SELECT window_start, '{name}' AS metric, CAST({name} AS DOUBLE) AS current FROM funnel"
            for name in ("events_per_second", "sessions", "unique_users", "total_revenue")
        )
        + f"""),
pairs AS (SELECT *, lag(current) OVER (PARTITION BY metric ORDER BY window_start) AS previous
          FROM kpis)
SELECT window_start, metric, round(current, 6) AS current, round(previous, 6) AS previous,
  {TRENDS} AS trend FROM pairs""",
        "latest_window": f"""WITH {GOLD}
SELECT {ROUNDED_FUNNEL} FROM (SELECT * FROM funnel ORDER BY window_start DESC LIMIT 1)""",
        "sparkline": f"""WITH {GOLD}
SELECT window_start, round(events_per_second, 6) AS events_per_second
FROM funnel ORDER BY window_start DESC LIMIT 30""",
        "funnel_stages": f"WITH {GOLD}, stages AS ("
        + " UNION ALL ".join(
            f"""SELECT window_start, CAST({i} AS INTEGER) AS position, '{label}' AS stage,
              {column} AS events, page_views AS base FROM funnel"""
            for i, (label, column) in enumerate(
                [
                    ("Page Views", "page_views"),
                    ("Product Views", "product_views"),
                    ("Add to Cart", "add_to_carts"),
                    ("Checkout", "checkout_starts"),
                    ("Purchases", "purchases"),
                ],
                1,
            )
        )
        + """)
SELECT window_start, position, stage, events,
  round(CASE WHEN base > 0 THEN events / base * 100 ELSE 0.0 END, 6) AS percent_of_first
FROM stages""",
        "revenue_share": f"""WITH {GOLD},
categories AS (SELECT category, sum(revenue) AS total_revenue FROM products
               WHERE category IS NOT NULL GROUP BY category)
SELECT category, round(total_revenue, 6) AS total_revenue,
  round(total_revenue / sum(total_revenue) OVER (), 6) AS share FROM categories""",
        "visit_share": f"""WITH {GOLD},
sources AS (SELECT traffic_source, CAST(sum(visits) AS BIGINT) AS total_visits FROM traffic
            GROUP BY traffic_source)
SELECT traffic_source, total_visits,
  round(total_visits / CAST(sum(total_visits) OVER () AS BIGINT), 6) AS share FROM sources""",
        "conversion_band": f"""WITH {GOLD}
SELECT CASE WHEN conversion_rate IS NULL THEN 'unknown' WHEN conversion_rate * 100 < 5 THEN '0-5'
            WHEN conversion_rate * 100 < 10 THEN '5-10' WHEN conversion_rate * 100 <= 20 THEN '10-20'
            ELSE '20+' END AS band, count(*) AS windows FROM funnel GROUP BY 1""",
        "health_levels": f"""WITH {GOLD}
SELECT CASE WHEN events_per_second <= 0 THEN 'red' WHEN events_per_second < 0.01 THEN 'yellow'
            ELSE 'green' END AS level, count(*) AS windows FROM funnel GROUP BY 1""",
        "session_rollup": f"""WITH {EVENTS}
SELECT session_id, min(user_id) AS user_id, CAST(min(happened_at) AS VARCHAR) AS started_at,
  CAST(max(happened_at) AS VARCHAR) AS ended_at, count(*) AS session_depth,
  count(*) FILTER (event_type = 'search') AS searches,
  bool_or(event_type = 'purchase') AS has_purchased, count(DISTINCT page) AS pages_visited,
  count(DISTINCT product_id) AS products_viewed,
  arg_max(category, (event_time, event_id)) FILTER (event_type = 'category_view') AS last_category
FROM good GROUP BY session_id""",
        "session_pages": f"""WITH {EVENTS}
SELECT session_id, page, CAST(min(happened_at) AS VARCHAR) AS first_seen, count(*) AS times
FROM good GROUP BY session_id, page""",
        "running_cart": f"""WITH RECURSIVE {CART}
SELECT session_id, CAST(happened_at AS VARCHAR) AS event_timestamp, event_id, event_type,
  round(amount, 6) AS amount, quantity, items,
  round(sum(amount) OVER (PARTITION BY session_id ORDER BY i), 6) AS cart_value
FROM changed""",
        "transition_matrix": f"""WITH {STEPS},
counts AS (SELECT from_type, to_type, count(*) AS n FROM steps
           WHERE from_type IS NOT NULL GROUP BY 1, 2)
SELECT from_type, to_type, n, round(n / CAST(sum(n) OVER (PARTITION BY from_type) AS BIGINT), 6)
  AS probability FROM counts""",
        "illegal_transitions": f"""WITH {STEPS}
SELECT session_id, CAST(happened_at AS VARCHAR) AS event_timestamp, event_id, from_type, to_type
FROM steps
WHERE (from_type IS NULL AND to_type <> 'page_view')
   OR (from_type IS NOT NULL AND (from_type, to_type) NOT IN ({ALLOWED}))""",
        "dimension_conformance": f"""WITH {EVENTS}
{_violations('device_system', 'device', 'operating_system', DEVICE_SYSTEMS)}
UNION ALL {_violations('source_campaign', 'traffic_source', 'campaign', SOURCE_CAMPAIGNS)}
UNION ALL {_violations('type_page', 'event_type', 'page', TYPE_PAGES)}""",
        "session_flags": f"""WITH {EVENTS},
numbered AS (
  SELECT event_id, session_id, user_id,
    row_number() OVER (PARTITION BY session_id ORDER BY event_time, event_id) = 1 AS is_entry,
    row_number() OVER (PARTITION BY session_id ORDER BY event_time DESC, event_id DESC) = 1 AS is_exit,
    count(*) OVER (PARTITION BY session_id) = 1 AS is_bounce,
    min(event_time) OVER (PARTITION BY session_id) AS started
  FROM good
)
SELECT event_id, session_id, is_entry, is_exit, is_bounce,
  dense_rank() OVER (PARTITION BY user_id ORDER BY started, session_id) AS session_number
FROM numbered""",
        "gap_sessions": f"WITH {GAP_SESSIONS}",
        "encode_messages": f"""WITH {EVENTS}
SELECT event_id AS key, CAST(to_json({{{', '.join(f"'{f}': {f}" for f in FIELDS)}}}) AS VARCHAR)
    AS value,
  'clickstream-events' AS topic, TRUE AS in_topic, event_type,
  'application/json' AS content_type, '1.0' AS schema_version
FROM ev""",
        "encode_dead_letters": f"""WITH {DELIVERED},
invalid AS (SELECT {COLUMNS} FROM parsed EXCEPT SELECT {COLUMNS} FROM valid)
SELECT event_id AS key, event_time, event_type, 'invalid event' AS error,
  epoch(TIMESTAMP '2024-01-31 00:05:00') AS failed_at, 'schema_validation' AS error_type
FROM invalid""",
        "union_evolved_schema": f"""WITH {EVENTS}
SELECT event_id, CASE WHEN happened_at >= TIMESTAMP '2024-01-16' THEN experiment_group END
    AS experiment_group,
  CAST(EXTRACT(hour FROM happened_at) AS INTEGER) AS hour,
  CAST(happened_at >= TIMESTAMP '2024-01-16' AS INTEGER) AS batch_id
FROM good""",
        "lake_time_range": f"""WITH {EVENTS}
SELECT event_id, event_time,
  CASE WHEN happened_at >= TIMESTAMP '2024-01-16' THEN experiment_group END AS experiment_group
FROM good
WHERE happened_at >= TIMESTAMP '2024-01-10 06:00:00' AND happened_at < TIMESTAMP '2024-01-20 19:00:00'""",
        "lake_sql": f"""WITH {EVENTS}
SELECT CAST(EXTRACT(day FROM happened_at) AS INTEGER) AS day, event_type, count(*) AS events,
  count(*) FILTER (happened_at >= TIMESTAMP '2024-01-16') AS grouped
FROM good GROUP BY 1, 2""",
        "stream_funnel": f"""WITH {EVENTS},
windows AS ({_funnel('good')}),
funnel AS ({_rates('windows', 300, f'WHERE w + INTERVAL 5 MINUTE <= {closed()}')})
SELECT {ROUNDED_FUNNEL} FROM funnel""",
        # A stream gives the steps that its watermark has passed.
        "stream_transitions": f"""WITH {STEPS},
counts AS (SELECT from_type, to_type, count(*) AS n FROM steps
           WHERE from_type IS NOT NULL AND happened_at < {closed()} GROUP BY 1, 2)
SELECT from_type, to_type, n, round(n / CAST(sum(n) OVER (PARTITION BY from_type) AS BIGINT), 6)
  AS probability FROM counts""",
        "stream_illegal_steps": f"""WITH {STEPS}
SELECT session_id, CAST(happened_at AS VARCHAR) AS event_timestamp, event_id, from_type, to_type
FROM steps
WHERE happened_at < {closed()}
  AND ((from_type IS NULL AND to_type <> 'page_view')
    OR (from_type IS NOT NULL AND (from_type, to_type) NOT IN ({ALLOWED})))""",
        "stream_running_cart": f"""WITH RECURSIVE {CART},
summed AS (
  SELECT *, sum(amount) OVER (PARTITION BY session_id ORDER BY i) AS total FROM changed
)
SELECT session_id, CAST(happened_at AS VARCHAR) AS event_timestamp, event_id, event_type,
  round(amount, 6) AS amount, quantity, items, round(total, 6) AS cart_value
FROM summed
WHERE happened_at < {closed("WHERE event_type IN ('add_to_cart', 'purchase', 'remove_from_cart')")}""",
        "stream_sliding": f"""WITH {EVENTS},
twice AS (
  SELECT *, time_bucket(INTERVAL 5 MINUTE, happened_at) - INTERVAL 5 MINUTE * back AS slot
  FROM good, (VALUES (0), (1)) AS b(back)
),
windows AS ({_funnel('twice', 'slot')}),
funnel AS ({_rates('windows', 600, f'WHERE w + INTERVAL 10 MINUTE <= {closed()}')})
SELECT {ROUNDED_FUNNEL} FROM funnel""",
        "stream_products": f"""WITH {EVENTS}, products AS ({_products('good')})
SELECT {ROUNDED_REVENUE} FROM products
WHERE CAST(window_end AS TIMESTAMP) <= {closed("WHERE product_id IS NOT NULL")}""",
        "stream_traffic": f"""WITH {EVENTS}, traffic AS ({_traffic('good')})
SELECT {ROUNDED_REVENUE} FROM traffic WHERE CAST(window_end AS TIMESTAMP) <= {closed()}""",
        "stream_dedup": f"""WITH {DELIVERED}
SELECT event_id, event_time, event_type, cart_value FROM silver""",
        "stream_gap_sessions": f"""WITH {GAP_SESSIONS}
WHERE last_at + INTERVAL 30 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 60 MINUTE""",
        # A session is over when every half hour that could continue it is.
        "stream_user_sessions": f"""WITH {GAP_SESSIONS}
WHERE ((epoch_us(last_at) + 1800000000) // 1800000000 + 1) * 1800000000
  <= (SELECT epoch_us(max(ts)) FROM events) - 3600000000""",
        "stream_silver": f"""WITH {DELIVERED}
SELECT {COLUMNS}, CAST(happened_at AS VARCHAR) AS event_timestamp,
  CAST(CAST(happened_at AS DATE) AS VARCHAR) AS event_date,
  CAST(EXTRACT(hour FROM happened_at) AS INTEGER) AS event_hour, {FLAGS}, {_hour_columns('happened_at')}
FROM silver""",
        "stream_gold": f"WITH {LAYERS} SELECT {ROUNDED_FUNNEL} FROM funnel",
        # Days are settled up to the one that the newest arrival of the first two deliveries, less
        # the delay, falls in; what was held back until then comes late.
        "stream_late_split": f"""WITH {DELIVERED},
marked AS (SELECT *, {_between(HELD_BACK)} AS held FROM silver),
settled AS (
  SELECT date_trunc('day', max(arrived) - INTERVAL 60 MINUTE) AS before FROM marked
  WHERE NOT held AND ts < TIMESTAMP '2024-01-21'
)
SELECT strftime(happened_at, '%Y-%m-%d') AS day,
  count(*) FILTER (NOT (held AND happened_at < before)) AS counted,
  count(*) FILTER (held AND happened_at < before) AS late
FROM marked, settled GROUP BY 1""",
        "stream_medallion": f"""WITH {LAYERS} {LAYER_ROWS}
UNION ALL SELECT 'dead_letter', count(*), NULL, NULL FROM message WHERE {REASON} IS NOT NULL
UNION ALL SELECT 'late_events', count(*), NULL, NULL FROM silver
  WHERE happened_at < arrived - INTERVAL 60 MINUTE""",
    }
    return {name: statement.strip() for name, statement in sql.items()}
