"""Builders of small event tables."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave import schemas
from clickweave.operators import events as ops

START = datetime(2024, 3, 1, 10, 0, 0)


def _defaults() -> dict:
    """A value for every field but id and time: the last of its domain, or else by its type."""
    by_type = {"string": None, "double": 0.0, "int": 0, "boolean": True}
    country, city = next(place for place in schemas.PLACES if place[0] == "Germany")
    domains = {
        "user_id": "user_000001",
        "session_id": "sess_1",
        "event_type": schemas.EVENT_TYPES[0],
        "page": "/",
        "device": schemas.DEVICES[-1],
        "browser": schemas.BROWSERS[-1],
        "operating_system": schemas.DEVICE_SYSTEMS[schemas.DEVICES[-1]][-1],
        "country": country,
        "city": city,
        "traffic_source": list(schemas.SOURCE_CAMPAIGNS)[-1],
        "campaign": list(schemas.SOURCE_CAMPAIGNS.values())[-1][-1],
        "referrer": schemas.REFERRERS[-1],
        "currency": "EUR",
        "experiment_group": schemas.EXPERIMENT_GROUPS[-1],
    }
    names = [f for f in schemas.EVENT if f.name not in ("event_id", "event_time")]
    return {f.name: domains.get(f.name, by_type[f.dataType.simpleString()]) for f in names}


DEFAULTS = _defaults()


def event(event_id: str, seconds: float = 0, **changes) -> dict:
    at = (START + timedelta(seconds=seconds)).isoformat(timespec="microseconds") + "Z"
    return {"event_id": event_id, "event_time": at, **DEFAULTS, **changes}


def events_df(spark: SparkSession, rows: list[dict]) -> DataFrame:
    names = schemas.EVENT.fieldNames()
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schemas.EVENT)


def silver_df(spark: SparkSession, rows: list[dict]) -> DataFrame:
    parsed = ops.parse_event_time(events_df(spark, rows))
    return ops.add_partition_columns(ops.clean_measures(parsed))


def message(row: dict | str | None, offset: int, arrived: float = 0) -> tuple:
    value = json.dumps(row) if isinstance(row, dict) else row
    key = row["event_id"] if isinstance(row, dict) else None
    return (
        None if key is None else bytearray(str(key), "utf-8"),
        None if value is None else bytearray(value, "utf-8"),
        "clickstream-events",
        offset % 3,
        offset,
        START + timedelta(seconds=arrived),
    )


def messages_df(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, schemas.MESSAGE)


def rows_of(df: DataFrame, *columns: str) -> list[tuple]:
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def same(left: DataFrame, right: DataFrame, digits: int = 9) -> bool:
    def flat(df: DataFrame) -> list[tuple]:
        exprs = [
            F.round(n, digits).alias(n) if kind == "double" else F.col(n).cast("string").alias(n)
            for n, kind in df.dtypes
        ]
        return rows_of(df.select(*exprs).select(*sorted(df.columns)))

    return flat(left) == flat(right)
