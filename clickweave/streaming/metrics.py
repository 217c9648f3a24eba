"""Streaming metrics and sessions: streams of final rows from state, and gold alone from messages.

`gold_streams` keep windows in the state store and drop events behind the watermark. `start_gold`
and the ingest query add parts to the lake instead; run one of the two for a lake, not both.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from clickweave.config import Settings
from clickweave.operators import events as ops
from clickweave.operators import messages as msg
from clickweave.operators import sessions, windows
from clickweave.plans import layers
from clickweave.session import adaptive
from clickweave.sinks.lake import Lake
from clickweave.streaming import ingest


def clean_stream(messages: DataFrame, settings: Settings, as_of: Column | None = None) -> DataFrame:
    """Valid, cleaned and watermarked events of a message stream, each id once."""
    as_of = F.col("timestamp") if as_of is None else as_of
    events = (
        msg.decode(messages).filter(msg.is_parsed()).select("event.*", as_of.alias("now"))
    )
    usable = layers.usable_events(
        events, F.col("now"), settings.max_age_days, settings.max_ahead_days
    ).drop("now")
    return deduplicated(usable, settings.watermark)


def deduplicated(events: DataFrame, watermark: str = "60 minutes") -> DataFrame:
    """Each event_id once across batches; ids are forgotten once the watermark passes them."""
    return events.withWatermark("event_timestamp", watermark).dropDuplicatesWithinWatermark(
        ["event_id"]
    )


def gold_streams(events: DataFrame, window: str = "5 minutes") -> dict[str, DataFrame]:
    return {
        "funnel_metrics": windows.funnel_metrics_exact(events, window),
        "product_performance": windows.product_performance(events, window),
        "traffic_analytics": windows.traffic_analytics(events, window),
    }


def append_to(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict,
    name: str | None = None,
    partitions: list[str] | None = None,
) -> StreamingQuery:
    """Write a stream's final rows as Parquet files, exactly once."""
    writer = (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
    )
    if name:
        writer = writer.queryName(name)
    if partitions:
        writer = writer.partitionBy(*partitions)
    return writer.start()


def start_gold(
    messages: DataFrame,
    lake: Lake,
    checkpoint: str,
    settings: Settings | None = None,
    trigger: dict | None = None,
    as_of: Column | None = None,
) -> StreamingQuery:
    """Start one query from messages to all gold tables, without the layers before them.

    Messages are read, decoded and deduplicated once. A window's metrics are final when its time
    partition is settled, which is when it ended more than the watermark delay before the newest
    arrival; events of settled time go to `late_events` with reason `late`, so each usable event is
    either in its windows or listed there. A new checkpoint needs a new lake.
    """
    settings = settings or Settings()
    ingest.check_window(settings)
    now = F.col(ingest.ARRIVED) if as_of is None else as_of
    decoded = msg.decode(messages).withColumn(ingest.INGESTED, F.current_timestamp())
    events = decoded.filter(msg.is_parsed()).select("event.*", ingest.INGESTED, now.alias("now"))
    usable = layers.usable_events(
        events, F.col("now"), settings.max_age_days, settings.max_ahead_days
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        with adaptive(batch.sparkSession):
            write_adaptively(batch, batch_id)

    def write_adaptively(batch: DataFrame, batch_id: int) -> None:
        key = ingest.batch_key(batch, batch_id)
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write_first(batch, key)
        finally:
            batch.unpersist()

    def write_first(batch: DataFrame, key: str) -> None:
        first = batch.filter(F.col(ingest.FIRST).isNotNull())
        first = first.select(F.col(ingest.FIRST).alias("event_id"))
        # Of the copies in a batch the earliest counts, in whatever order its files are read.
        events = batch.filter(F.col(ingest.FIRST).isNull()).drop(ingest.FIRST)
        once = ops.deduplicate(events, [F.col("event_timestamp"), F.col("now")])
        new = once.join(first, "event_id", "left_semi").select(*once.columns)
        new = new.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            latest = new.agg(F.max("now").cast("string")).first()[0]
            if latest is None:
                return
            late = ingest.add_gold(lake, new, key, latest, settings, divert=True)
            if late is not None:
                rows = layers.silver_columns(late, F.col(ingest.INGESTED))
                rows = rows.withColumn("late_reason", F.lit("late"))
                lake.append(rows.drop(ingest.INGESTED, "now"), "late_events", key)
        finally:
            new.unpersist()

    ids = ingest.unseen(usable.select("event_id", ingest.INGESTED), settings.id_days)
    first = ids.select(F.col("event_id").alias(ingest.FIRST))
    stream = usable.withColumn(ingest.FIRST, F.lit(None).cast("string"))
    return (
        stream.unionByName(first, allowMissingColumns=True)
        .writeStream.foreachBatch(write)
        .queryName("clickstream_gold")
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or settings.trigger))
        .start()
    )


def gap_session_stream(events: DataFrame, watermark: str = "60 minutes") -> DataFrame:
    return sessions.gap_session_windows(events.withWatermark("event_timestamp", watermark))


def late_rows(events: DataFrame, arrived: Column, watermark: str = "60 minutes") -> DataFrame:
    """Events that arrived more than the watermark delay after they happened."""
    return ops.split_late(events, arrived - F.expr(f"interval {watermark}"))[1]


def dropped_late_rows(query: StreamingQuery) -> int:
    """Rows dropped behind the watermark in the recent progress reports, of which Spark keeps few.

    For all of a long-running query add a `DroppedRows` listener before it starts.
    """
    return sum(
        int(operator["numRowsDroppedByWatermark"])
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )


class DroppedRows(StreamingQueryListener):
    """Counts rows dropped behind the watermark per query id, over all its batches."""

    def __init__(self) -> None:
        self.total: dict[str, int] = defaultdict(int)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        self.total[str(progress.id)] += sum(
            operator.numRowsDroppedByWatermark for operator in progress.stateOperators
        )

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
