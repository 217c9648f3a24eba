"""Row-level event operators: time, validation, cleaning, flags, deduplication."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickweave import schemas
from clickweave.functions import measures, time

STRICT_FIELDS = ["event_id", "event_time", "user_id", "session_id", "event_type", "page"]


def parse_event_time(events: DataFrame, keep_fraction: bool = False) -> DataFrame:
    """Add `event_timestamp`.

    The one-element explode keeps the parse where it is. As a plain column, every later filter
    and window bound on the time would be pushed down with a parse of its own.
    """
    parsed = time.event_timestamp(F.col("event_time"), keep_fraction)
    return events.select("*", F.explode(F.array(parsed)).alias("event_timestamp"))


def add_partition_columns(events: DataFrame) -> DataFrame:
    return events.withColumns(time.hour_columns(F.col("event_timestamp")))


def add_date_columns(events: DataFrame) -> DataFrame:
    return events.withColumns(
        {
            "event_date": F.to_date("event_timestamp"),
            "event_hour": F.hour("event_timestamp"),
        }
    )


def add_event_flags(events: DataFrame) -> DataFrame:
    """Type flags. `is_bounce` is a constant here; `sessions.session_flags` has the true one."""
    kind = F.col("event_type")
    return events.withColumns(
        {
            "is_purchase": kind == "purchase",
            "is_cart_add": kind == "add_to_cart",
            "is_page_view": kind == "page_view",
            "is_checkout": kind.isin(schemas.CHECKOUT_TYPES),
            "is_bounce": F.lit(False),
        }
    )


def clean_measures(events: DataFrame) -> DataFrame:
    return events.withColumns(
        {
            "price": measures.clean_amount(F.col("price")),
            "quantity": measures.clean_quantity(F.col("quantity")),
            "cart_value": measures.clean_amount(F.col("cart_value")),
        }
    )


def within_range(
    events: DataFrame,
    as_of: Column | None = None,
    max_age_days: int = 7,
    max_ahead_days: int = 1,
) -> DataFrame:
    """Drop events too old or too far ahead of `as_of` (default now), and undated ones."""
    as_of = F.current_timestamp() if as_of is None else as_of
    return events.filter(
        time.in_range(F.col("event_timestamp"), as_of, max_age_days, max_ahead_days)
    )


def is_valid() -> Column:
    """True or false, never NULL: known type, non-empty id, user and session present."""
    check = (
        F.col("event_type").isin(schemas.EVENT_TYPES)
        & (F.col("event_id") != "")
        & F.col("user_id").isNotNull()
        & F.col("session_id").isNotNull()
    )
    return F.coalesce(check, F.lit(False))


def is_strictly_valid() -> Column:
    """Also demands time and page, and no empty strings."""
    filled = [F.col(name) != "" for name in STRICT_FIELDS]
    return F.coalesce(
        reduce(and_, filled) & F.col("event_type").isin(schemas.EVENT_TYPES), F.lit(False)
    )


def split_valid(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and the distinct invalid rows.

    The invalid side is the set difference events - valid. Validity depends on the row alone, so
    a filter plus distinct gives the same set without joining the table to itself, and repeated
    copies collapse before the shuffle. On a stream use `filter(~is_valid())`.
    """
    invalid = events.filter(~is_valid())
    return events.filter(is_valid()), invalid if events.isStreaming else invalid.distinct()


def first_per_key(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first by `order`, then by row content, so reruns agree.

    The rank filter is pushed below the shuffle: each task sends at most one row per key, however
    many copies a hot key has.
    """
    content = F.xxhash64(*[F.col(c) for c in rows.columns])
    window = Window.partitionBy(*keys).orderBy(*order, content)
    return (
        rows.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")
    )


def deduplicate(events: DataFrame, order: list[Column] | None = None) -> DataFrame:
    """Batch: one row per event_id, the earliest by `order` (default event_timestamp)."""
    return first_per_key(events, ["event_id"], order or [F.col("event_timestamp")])


def split_late(events: DataFrame, watermark: Column) -> tuple[DataFrame, DataFrame]:
    """Events at or after the watermark, and those that came too late."""
    late = F.col("event_timestamp") < watermark
    return events.filter(~late), events.filter(late)
