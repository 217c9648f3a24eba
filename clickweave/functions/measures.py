"""Cleaning of numeric fields, ratios, and graded levels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOWEST_QUANTITY = -100


def clean_amount(amount: Column) -> Column:
    """Missing, NaN and negative money becomes 0."""
    return F.when(amount.isNull() | F.isnan(amount) | (amount < 0), 0.0).otherwise(amount)


def clean_quantity(quantity: Column) -> Column:
    """Missing and absurdly negative quantities become 0; removals stay negative."""
    return F.when(quantity.isNull() | (quantity < LOWEST_QUANTITY), 0).otherwise(quantity)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0.0 where whole is not positive."""
    return F.when(whole > 0, part / whole).otherwise(0.0)


def count_of(event_type: Column, *types: str) -> Column:
    """Number of rows whose type is one of `types`."""
    match = event_type == types[0] if len(types) == 1 else event_type.isin(*types)
    return F.count_if(match)


def health_level(value: Column, warn_below: float, error_below: float = 0) -> Column:
    """red at or below `error_below` and without a value, yellow below `warn_below`, else green."""
    low = value.isNull() | (value <= error_below)
    return F.when(low, "red").when(value < warn_below, "yellow").otherwise("green")


def recency_level(text: Column, parsed: Column, as_of: Column, max_minutes: int = 5) -> Column:
    """green under `max_minutes` old, yellow under three times that, else red.

    No timestamp at all is red; one that cannot be parsed is yellow.
    """
    age = F.unix_seconds(as_of) - F.unix_seconds(parsed)
    return (
        F.when(text.isNull(), "red")
        .when(parsed.isNull(), "yellow")
        .when(age < max_minutes * 60, "green")
        .when(age < max_minutes * 60 * 3, "yellow")
        .otherwise("red")
    )


def trend(current: Column, previous: Column, inverse_good: bool = False) -> Column:
    """flat below a 1 % change or without a base to compare to, else up or down."""
    change = F.when(previous != 0, (current - previous) / previous)
    rising, falling = ("down", "up") if inverse_good else ("up", "down")
    return (
        F.when(change.isNull() | (F.abs(change) < 0.01), "flat")
        .when(change > 0, rising)
        .otherwise(falling)
    )


def conversion_band(percent: Column) -> Column:
    """Gauge band of a conversion percentage; the gauge ends at 20, the rate does not."""
    return (
        F.when(percent.isNull(), "unknown")
        .when(percent < 5, "0-5")
        .when(percent < 10, "5-10")
        .when(percent <= 20, "10-20")
        .otherwise("20+")
    )
