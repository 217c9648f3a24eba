"""Maps a generic activity log onto the event model.

The log has (event_id, ts, user_id, event_type, value, props) with `props` = {"k": n}. All rows
are kept. `messages` adds delivery faults, chosen by `k`, so that every route of the ingest path
carries traffic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave import schemas

TOPIC = "clickstream-events"
TOPIC_PARTITIONS = 6
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"

# Inclusive ranges of k with a delivery fault.
DELIVERED_TWICE = (50, 54)
TEN_DAYS_OLD = (60, 61)
THREE_HOURS_OLD = (62, 63)
NEGATIVE_CART = (70, 74)
MISSING_PRICE = (80, 84)
ABSURD_QUANTITY = (85, 87)
UNTERMINATED = (90, 91)
EMPTY_ID = (92, 93)


def _k() -> Column:
    return F.col("k")


# What each kind of logged activity turns into; k chooses among several.
ACTIVITY_TYPES = {
    "view": ["page_view", "product_view"],
    "click": ["search", "category_view", "add_to_cart", "remove_from_cart", "begin_checkout"],
    "signup": ["payment", "logout"],
    "purchase": ["purchase"],
}
PRODUCT_TYPES = ["product_view", "add_to_cart", "remove_from_cart", "purchase"]
PAGES = {
    **schemas.TYPE_PAGES,
    "category_view": [f"/category/{name}" for name in schemas.CATEGORIES],
}


def _array(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _pick(values: list[str], index: Column) -> Column:
    return F.get(_array(values), index.cast("int"))


def _choose(lists: dict[str, list[str]], name: Column, index: Column) -> Column:
    """The index-th entry, counted round and round, of the list called `name`."""
    table = F.create_map(*[c for k, v in lists.items() for c in (F.lit(k), _array(v))])
    found = F.try_element_at(table, name)
    return F.get(found, index % F.size(found))


def _in(bounds: tuple[int, int]) -> Column:
    return _k().between(*bounds)


def _base(log: DataFrame) -> DataFrame:
    # The one-element explode parses `props` once; later filters cannot pull the parse apart.
    return log.select(
        F.col("event_id").alias("n"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("user_id").alias("u"),
        "event_type",
        "value",
        F.explode(F.array(F.get_json_object("props", "$.k").cast("int"))).alias("k"),
    ).withColumn(
        "kind",
        F.coalesce(_choose(ACTIVITY_TYPES, F.col("event_type"), _k()), F.col("event_type")),
    )


def _with_event_columns(base: DataFrame, event_id: Column, ts: Column) -> DataFrame:
    kind, user = F.col("kind"), F.col("u")
    about_product = kind.isin(PRODUCT_TYPES)
    campaigns = [c for group in schemas.SOURCE_CAMPAIGNS.values() for c in group]
    systems = ["iOS", "Android", "Windows", "macOS", "Linux"]
    user_id = F.when(user.isNotNull(), F.format_string("user_%06d", user.cast("long")))
    return base.withColumns(
        {
            "event_id": event_id,
            "event_time": F.date_format(ts, ISO_MICROS),
            "user_id": user_id,
            "session_id": F.concat(
                F.lit("sess_"),
                user.cast("string"),
                F.lit("_"),
                F.date_format("ts", "yyyyMMdd"),
            ),
            "event_type": kind,
            "page": F.coalesce(_choose(PAGES, kind, _k()), F.lit("/")),
            "product_id": F.when(
                about_product,
                F.concat(F.lit("prod_"), F.lpad((_k() % 50).cast("string"), 3, "0")),
            ),
            "category": F.when(
                about_product | (kind == "category_view"), _pick(schemas.CATEGORIES, _k() % 10)
            ),
            "device": _pick(schemas.DEVICES, user % 3),
            "browser": _pick(schemas.BROWSERS, user % 4),
            "operating_system": _pick(systems, user % 5),
            "country": _pick([country for country, _ in schemas.PLACES], user % 11),
            "city": _pick([city for _, city in schemas.PLACES], user % 11),
            "traffic_source": _pick(list(schemas.SOURCE_CAMPAIGNS), user % 6),
            "campaign": _pick(campaigns, _k() % len(campaigns)),
            "referrer": _pick(schemas.REFERRERS, _k() % 5),
            "price": F.col("value"),
            "quantity": F.when(kind == "remove_from_cart", -1).otherwise(_k() % 4),
            "cart_value": F.col("value"),
            "currency": F.lit("USD"),
            "experiment_group": _pick(schemas.EXPERIMENT_GROUPS, user % 3),
            "is_logged_in": user % 2 == 0,
        }
    )


def events(log: DataFrame) -> DataFrame:
    """The log as clean events, one per row."""
    shaped = _with_event_columns(_base(log), F.col("n").cast("string"), F.col("ts"))
    return shaped.select(*schemas.EVENT.fieldNames())


def messages(log: DataFrame) -> DataFrame:
    """The log as topic messages, with delivery faults. Arrival is two seconds after the event."""
    base = _base(log).withColumn(
        "copy",
        F.explode(
            F.when(_in(DELIVERED_TWICE), F.array(F.lit(0), F.lit(1))).otherwise(
                F.array(F.lit(0))
            )
        ),
    )
    stated = (
        F.when(_in(TEN_DAYS_OLD), F.col("ts") - F.expr("interval 10 days"))
        .when(_in(THREE_HOURS_OLD), F.col("ts") - F.expr("interval 3 hours"))
        .otherwise(F.col("ts"))
    )
    event_id = F.when(_in(EMPTY_ID), "").otherwise(F.col("n").cast("string"))
    shaped = _with_event_columns(base, event_id, stated).withColumns(
        {
            "price": F.when(~_in(MISSING_PRICE), F.col("price")),
            "cart_value": F.when(_in(NEGATIVE_CART), 0 - F.col("cart_value")).otherwise(
                F.col("cart_value")
            ),
            "quantity": F.when(_in(ABSURD_QUANTITY), -200).otherwise(F.col("quantity")),
        }
    )
    extra = ["n", "u", "k", "ts", "copy"]
    fields = schemas.EVENT.fieldNames()
    value = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    # An object that is never closed.
    opened = F.format_string('{"event_id":"%s","event_time":"%s"', "event_id", "event_time")
    return shaped.select(*fields, *extra).select(
        F.col("event_id").cast("binary").alias("key"),
        F.when(_in(UNTERMINATED), opened).otherwise(value).cast("binary").alias("value"),
        F.lit(TOPIC).alias("topic"),
        (F.col("u") % TOPIC_PARTITIONS).cast("int").alias("partition"),
        (F.col("n") * 2 + F.col("copy")).alias("offset"),
        (F.col("ts") + F.expr("interval 2 seconds")).alias("timestamp"),
    )
