"""Decoding messages into events and encoding events into messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweave import schemas
from clickweave.functions.time import event_timestamp, hour_columns, in_range

FAILED_PARSE = "failed_parse"
SCHEMA_VERSION = "1.0"
CONTENT_TYPE = "application/json"
UNKNOWN_KEY = "unknown"


def decode(messages: DataFrame, schema: T.StructType = schemas.EVENT) -> DataFrame:
    """Add the parsed `event` struct to each message; a bad payload gives NULL fields.

    The one-element explode keeps filters on event fields above the parse. Without it they are
    pushed below and every one of them parses the payload again.
    """
    event = F.from_json(F.col("value").cast("string"), schema)
    return messages.select("*", F.explode(F.array(event)).alias("event"))


def payload() -> Column:
    """The whole payload as VARIANT, with the fields the schema does not have; NULL if it is no JSON.

    A new field can be read from it before any schema knows it: `payload:new_field::string`.
    """
    return F.try_parse_json(F.col("value").cast("string"))


def is_parsed() -> Column:
    return F.col("event.event_id").isNotNull()


def split_decoded(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Messages with and without a usable event."""
    return decoded.filter(is_parsed()), decoded.filter(~is_parsed())


def parse_messages(messages: DataFrame, schema: T.StructType = schemas.EVENT) -> DataFrame:
    """The events of all usable messages, one column per field."""
    return decode(messages, schema).filter(is_parsed()).select("event.*")


def message_counts(decoded: DataFrame) -> DataFrame:
    """One row: total, valid and invalid messages, from a single pass."""
    return decoded.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(is_parsed()).alias("valid"),
        F.count_if(~is_parsed()).alias("invalid"),
    )


def failure_reason(as_of: Column, max_age_days: int = 7, max_ahead_days: int = 1) -> Column:
    """Why a decoded message cannot become a silver row; NULL if it can."""
    event = F.col("event")
    stamp = event_timestamp(event["event_time"])
    missing = (
        (event["event_id"] == "") | event["user_id"].isNull() | event["session_id"].isNull()
    )
    in_time = F.coalesce(in_range(stamp, as_of, max_age_days, max_ahead_days), F.lit(False))
    known = F.coalesce(event["event_type"].isin(schemas.EVENT_TYPES), F.lit(False))
    return (
        F.when(~is_parsed(), FAILED_PARSE)
        .when(missing, "missing_required")
        .when(~known, "invalid_event_type")
        .when(~in_time, "out_of_range")
    )


def dead_letters(
    decoded: DataFrame, reason: Column | str = FAILED_PARSE, failed_at: Column | None = None
) -> DataFrame:
    """Keep the raw message with the reason and time of its failure."""
    failed_at = F.current_timestamp() if failed_at is None else failed_at
    reason = F.lit(reason) if isinstance(reason, str) else reason
    return decoded.select(
        F.col("key").cast("string").alias("raw_key"),
        F.col("value").cast("string").alias("raw_value"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        reason.alias("failure_reason"),
        failed_at.cast("string").alias("failure_timestamp"),
        *[c.alias(name) for name, c in hour_columns(failed_at).items()],
    )


def _header(name: str, value: Column | str) -> Column:
    value = F.lit(value) if isinstance(value, str) else value
    return F.struct(F.lit(name).alias("key"), value.cast("binary").alias("value"))


def _json(*fields: Column) -> Column:
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def encode_events(events: DataFrame, topic: str, partitions: int = 6) -> DataFrame:
    """Events as topic messages; a session always lands in the same partition."""
    return events.select(
        F.col("event_id").cast("binary").alias("key"),
        _json(*[F.col(c) for c in events.columns]).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.pmod(F.xxhash64("session_id"), F.lit(max(partitions, 1)))
        .cast("int")
        .alias("partition"),
        F.array(
            _header("event_type", F.col("event_type")),
            _header("content_type", CONTENT_TYPE),
            _header("schema_version", SCHEMA_VERSION),
        ).alias("headers"),
    )


def encode_dead_letters(
    events: DataFrame, error: Column, topic: str, failed_at: Column | None = None
) -> DataFrame:
    """Rejected events as dead-letter messages carrying the event, the error and unix time."""
    failed_at = F.current_timestamp() if failed_at is None else failed_at
    event = F.struct(*[F.col(c) for c in events.columns])
    return events.select(
        F.coalesce(F.col("event_id"), F.lit(UNKNOWN_KEY)).cast("binary").alias("key"),
        _json(
            event.alias("original_event"),
            error.alias("error"),
            (F.unix_micros(failed_at) / 1e6).alias("timestamp"),
        )
        .cast("binary")
        .alias("value"),
        F.lit(topic).alias("topic"),
        F.array(
            _header("error_type", "schema_validation"), _header("content_type", CONTENT_TYPE)
        ).alias("headers"),
    )
