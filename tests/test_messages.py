import json

import pytest
from pyspark.sql import functions as F

from clickweave import schemas
from clickweave.config import Settings
from clickweave.operators import messages as msg
from clickweave.sinks import topics
from tests.helpers import START, event, events_df, message, messages_df, rows_of

BROKEN = ["{bad", '{"event_id":"a"', "null", "[]", '[{"event_id":"a"}]', "{}", "", None]


def _parse_one(spark, payload):
    return msg.parse_messages(messages_df(spark, [message(payload, 1)])).collect()


@pytest.mark.parametrize("payload", BROKEN)
def test_unusable_payloads_have_no_event(spark, payload):
    assert _parse_one(spark, payload) == []


def test_usable_and_unusable_split_without_loss(spark):
    payloads = [event("a"), "{bad", None, {"event_id": 5}, {"event_id": ""}]
    decoded = msg.decode(messages_df(spark, [message(p, i) for i, p in enumerate(payloads)]))
    good, bad = msg.split_decoded(decoded)
    assert rows_of(good.select("event.event_id")) == [("",), ("5",), ("a",)]
    assert bad.count() == 2
    assert rows_of(msg.message_counts(decoded)) == [(5, 3, 2)]


@pytest.mark.parametrize(
    "field, value",
    [("price", "x"), ("price", "9.5"), ("quantity", "2"), ("quantity", 2.5), ("quantity", 2**40)],
)
def test_wrong_typed_field_becomes_null_and_the_row_stays(spark, field, value):
    (row,) = _parse_one(spark, event("a", **{field: value}))
    assert row.event_id == "a" and row[field] is None


def test_object_id_becomes_text_and_unknown_fields_vanish(spark):
    (row,) = _parse_one(spark, {"event_id": {"x": 1}, "new_field": 1})
    assert row.event_id == '{"x":1}' and "new_field" not in row


def test_metadata_is_read_only_when_asked_for(spark):
    payload = {**event("a"), "metadata": {"session_depth": 3, "page_load_time_ms": 250}}
    messages = messages_df(spark, [message(payload, 1)])
    assert "metadata" not in msg.parse_messages(messages).columns
    (row,) = msg.parse_messages(messages, schemas.EVENT_WITH_METADATA).collect()
    assert row.metadata.session_depth == 3 and row.metadata.viewport_width is None


def test_dead_letters_keep_the_raw_message(spark):
    decoded = msg.decode(messages_df(spark, [message(event("a"), 1), message("{bad", 2)]))
    _, bad = msg.split_decoded(decoded)
    rows = msg.dead_letters(bad, failed_at=F.lit(START).cast("timestamp"))
    assert rows.schema.fieldNames() == schemas.DEAD_LETTER.fieldNames()
    assert rows_of(rows) == [
        (None, "{bad", "clickstream-events", 2, 2, "failed_parse", "2024-03-01 10:00:00")
        + (2024, 3, 1, 10)
    ]


def test_failure_reasons(spark):
    cases = {
        "ok": event("a"),
        "failed_parse": "{bad",
        "missing_required": event("b", user_id=None),
        "invalid_event_type": event("c", event_type="teleport"),
        "out_of_range": event("d", seconds=-8 * 86_400),
    }
    rows = [message(payload, i) for i, payload in enumerate(cases.values())]
    rows.append(message(event("e", event_time="never"), 5))
    rows.append(message(event("f", event_type=None), 6))
    rows.append(message(event("", user_id="u"), 7))
    reasons = msg.decode(messages_df(spark, rows)).select(
        "offset", msg.failure_reason(F.col("timestamp")).alias("reason")
    )
    found = [r.reason for r in reasons.orderBy("offset").collect()]
    assert found == [None, *list(cases)[1:], "out_of_range", "invalid_event_type", "missing_required"]


def test_encoding_then_decoding_returns_the_events(spark):
    rows = [event("a", price=9.99, quantity=2), event("b", session_id="sess_2", campaign=None)]
    events = events_df(spark, rows)
    encoded = msg.encode_events(events, "topic", 6)
    back = msg.parse_messages(
        encoded.select("key", "value", "topic", "partition")
        .withColumn("offset", F.lit(0).cast("long"))
        .withColumn("timestamp", F.current_timestamp())
    )
    assert rows_of(back) == rows_of(events)


def test_encoding_states_nulls_headers_and_a_stable_partition(spark):
    events = events_df(spark, [event("a"), event("b"), event("c", session_id="other")])
    rows = msg.encode_events(events, "topic", 6).collect()
    body = json.loads(bytes(rows[0].value))
    assert body["product_id"] is None and list(body) == schemas.EVENT.fieldNames()
    assert rows[0].partition == rows[1].partition and 0 <= rows[2].partition < 6
    assert {h.key: bytes(h.value).decode() for h in rows[0].headers} == {
        "event_type": "page_view",
        "content_type": "application/json",
        "schema_version": "1.0",
    }


def test_dead_letter_messages(spark):
    events = events_df(spark, [event("a"), event(None)])
    failed_at = F.lit("2024-03-01 10:00:00.5").cast("timestamp")
    rows = msg.encode_dead_letters(events, F.lit("broken"), "dead", failed_at).collect()
    assert sorted(bytes(r.key).decode() for r in rows) == ["a", "unknown"]
    body = json.loads(bytes(rows[0].value))
    assert body["error"] == "broken" and body["original_event"]["event_id"] == "a"
    assert body["timestamp"] == 1709287200.5


def test_schemas_do_not_share_fields():
    assert len(schemas.EVENT) == 22 and len(schemas.BRONZE) == 28
    assert "ingestion_timestamp" not in schemas.EVENT.fieldNames()


def test_topic_messages_have_the_columns_of_the_sink(spark):
    settings = Settings(topic="t", dead_letter_topic="d", topic_partitions=3)
    rows = events_df(spark, [event("1"), event("2", session_id="other")])
    sent = topics.event_messages(rows, settings)
    assert sent.columns == ["key", "value", "topic", "partition", "headers"]
    assert {r["topic"] for r in sent.collect()} == {"t"}
    assert all(0 <= r["partition"] < 3 for r in sent.collect())
    dead = topics.dead_letter_messages(rows, F.lit("bad"), settings)
    assert dead.columns == ["key", "value", "topic", "headers"]
    assert {r["topic"] for r in dead.collect()} == {"d"}
    with_more = sent.withColumn("offset", F.lit(1))
    assert topics.outgoing(with_more).columns == sent.columns


def test_topic_writer_options():
    options = topics.writer_options(Settings(bootstrap_servers="broker:1"))
    assert options == {"kafka.bootstrap.servers": "broker:1", "kafka.acks": "all"}
