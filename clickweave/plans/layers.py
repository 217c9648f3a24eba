"""Bronze, silver and gold as functions of the events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.operators import events as ops
from clickweave.operators import windows


def bronze_rows(
    events: DataFrame, ingested_at: Column | None = None, valid_only: bool = True
) -> DataFrame:
    """Raw events with parsed time, ingestion stamp and partition columns.

    `valid_only=False` keeps every parsed row and adds `is_valid`.
    """
    stamp = F.current_timestamp() if ingested_at is None else ingested_at
    rows = ops.add_partition_columns(
        ops.parse_event_time(events).withColumn("ingestion_timestamp", stamp.cast("string"))
    )
    if valid_only:
        return rows.filter(ops.is_valid())
    return rows.withColumn("is_valid", ops.is_valid())


def usable_events(
    events: DataFrame,
    as_of: Column | None = None,
    max_age_days: int = 7,
    max_ahead_days: int = 1,
) -> DataFrame:
    """Valid events in the allowed time range with cleaned measures; duplicates remain."""
    dated = ops.parse_event_time(events.filter(ops.is_valid()))
    return ops.clean_measures(ops.within_range(dated, as_of, max_age_days, max_ahead_days))


def silver_columns(usable: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    stamp = F.current_timestamp() if ingested_at is None else ingested_at
    rows = ops.add_event_flags(ops.add_date_columns(usable))
    return ops.add_partition_columns(rows).withColumn(
        "ingestion_timestamp", stamp.cast("string")
    )


def silver_rows(
    events: DataFrame,
    as_of: Column | None = None,
    ingested_at: Column | None = None,
    max_age_days: int = 7,
    max_ahead_days: int = 1,
) -> DataFrame:
    """Validated, cleaned, deduplicated and enriched events.

    Duplicates go before the derived columns are added, so less is shuffled.
    """
    usable = usable_events(events, as_of, max_age_days, max_ahead_days)
    return silver_columns(ops.deduplicate(usable), ingested_at)


def gold_tables(silver: DataFrame, window: str = "5 minutes") -> dict[str, DataFrame]:
    return {
        "funnel_metrics": windows.funnel_metrics(silver, window),
        "product_performance": windows.product_performance(silver, window),
        "traffic_analytics": windows.traffic_analytics(silver, window),
    }
