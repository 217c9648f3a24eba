"""Event-time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted text forms. ISO time is UTC; a fraction needs its Z.
ISO_TEXT = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d((\.\d+)?Z)?$"
LAYER_TEXT = r"^\d{4}-\d\d-\d\d[ T]\d\d:\d\d:\d\d(\.\d+)?Z?$"


def event_timestamp(event_time: Column, keep_fraction: bool = False) -> Column:
    """Parse ISO-8601 UTC text with or without a fraction; anything else gives NULL.

    Sub-seconds are cut off unless `keep_fraction` is set. Checking the form and casting costs
    half of what a pattern-based parse does.
    """
    parsed = F.when(event_time.rlike(ISO_TEXT), event_time.try_cast("timestamp"))
    return parsed if keep_fraction else F.date_trunc("second", parsed)


def any_timestamp(text: Column) -> Column:
    """Parse either of the text forms the layers store: ISO with `Z`, or `date time`."""
    return F.when(text.rlike(LAYER_TEXT), F.date_trunc("second", text.try_cast("timestamp")))


def hour_columns(ts: Column) -> dict[str, Column]:
    """The four lake partition columns of a timestamp."""
    return {
        "year": F.year(ts),
        "month": F.month(ts),
        "day": F.dayofmonth(ts),
        "hour": F.hour(ts),
    }


def in_range(ts: Column, as_of: Column, max_age_days: int = 7, max_ahead_days: int = 1) -> Column:
    """Whether `ts` lies in [as_of - max_age, as_of + max_ahead]; NULL `ts` gives NULL."""
    return ts.between(
        as_of - F.make_dt_interval(F.lit(max_age_days)),
        as_of + F.make_dt_interval(F.lit(max_ahead_days)),
    )


def time_slice(ts: Column, seconds: int) -> Column:
    """Number of the fixed-length slice of time a timestamp falls in."""
    return F.floor(F.unix_seconds(ts) / seconds)
