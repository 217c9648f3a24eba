"""Writers of encoded messages to topics; they need Spark's Kafka package on the classpath."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from clickweave.config import Settings
from clickweave.operators import messages as msg

SINK = "kafka"
#: Columns that the sink knows; a topic column says where each message goes.
COLUMNS = ["key", "value", "topic", "partition", "headers"]


def writer_options(settings: Settings) -> dict[str, str]:
    """Every replica confirms a message, so that a lost broker loses none."""
    return {"kafka.bootstrap.servers": settings.bootstrap_servers, "kafka.acks": "all"}


def outgoing(messages: DataFrame) -> DataFrame:
    """The columns of encoded messages that the sink takes."""
    return messages.select(*[name for name in COLUMNS if name in messages.columns])


def event_messages(events: DataFrame, settings: Settings) -> DataFrame:
    return outgoing(msg.encode_events(events, settings.topic, settings.topic_partitions))


def dead_letter_messages(
    events: DataFrame, error: Column, settings: Settings, failed_at: Column | None = None
) -> DataFrame:
    return outgoing(
        msg.encode_dead_letters(events, error, settings.dead_letter_topic, failed_at)
    )


def to_topic(messages: DataFrame, settings: Settings) -> None:
    """Write a table of messages. A task that runs again sends its messages again."""
    outgoing(messages).write.format(SINK).options(**writer_options(settings)).save()


def stream_to_topic(
    messages: DataFrame, settings: Settings, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Write a stream of messages, each at least once; readers deduplicate by event id."""
    return (
        outgoing(messages)
        .writeStream.format(SINK)
        .options(**writer_options(settings))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or settings.trigger))
        .start()
    )
