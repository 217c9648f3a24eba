import pytest
from pyspark.sql import functions as F

from clickweave import schemas
from clickweave.config import Settings
from clickweave.functions.time import in_range
from clickweave.operators import events as ops
from clickweave.operators import messages as msg
from clickweave.operators import sessions, windows
from clickweave.plans import layers, serving
from clickweave.session import streaming_session
from clickweave.sinks.lake import DAYS, Lake
from clickweave.sources.messages import file_batch, file_stream
from clickweave.streaming import ingest, metrics
from tests.helpers import event, message, messages_df, rows_of, same

ONCE = {"availableNow": True}
SETTINGS = Settings()


def _batches() -> list[list[tuple]]:
    """Five files: copies within and across files, bad messages, late and far-off events."""
    kinds = ["page_view", "product_view", "add_to_cart", "purchase", "search"]

    def good(i, seconds, arrived=None, **changes):
        row = event(
            f"e{i}",
            seconds,
            event_type=kinds[i % 5],
            user_id=f"u{i % 4}",
            session_id=f"s{i % 6}",
            product_id=f"p{i % 3}" if i % 5 else None,
            cart_value=float(i),
            **changes,
        )
        return row, seconds if arrived is None else arrived

    plan = [
        [good(i, i * 20) for i in range(20)] + [good(3, 60), ("{bad", 61)],
        [good(i, i * 60) for i in range(20, 60)] + [good(3, 60, 1300), good(5, 100, 1301)],
        [good(i, 9000 + i * 10) for i in range(60, 90)]
        + [good(91, -10 * 86_400, 9901)]
        + [({"event_id": "e92", "event_type": "teleport"}, 9902), (event(""), 9903)],
        [good(i, 30_000 + i) for i in range(93, 100)],
        [good(90, 100, 30_120), good(100, 30_121)],
    ]
    out, offset = [], 0
    for rows in plan:
        out.append([])
        for payload, arrived in rows:
            out[-1].append(message(payload, offset, arrived))
            offset += 1
    return out


@pytest.fixture
def topic(spark, tmp_path):
    """A folder of message files; modification order is arrival order."""
    path = str(tmp_path / "topic")
    for rows in _batches():
        messages_df(spark, rows).coalesce(1).write.mode("append").parquet(path)
    return path


def _stream(spark, topic):
    return file_stream(streaming_session(spark), topic, max_files_per_trigger=1)


def _collect(spark, rows, tmp_path, name):
    out = str(tmp_path / name)
    query = metrics.append_to(rows, out, str(tmp_path / f"{name}-checkpoint"), ONCE)
    query.awaitTermination()
    return spark.read.schema(rows.schema).parquet(out), query


def _expected(spark, topic):
    arrived = F.col("timestamp")
    decoded = msg.decode(file_batch(spark, topic))
    events = decoded.filter(msg.is_parsed()).select("event.*", arrived)
    silver = layers.silver_rows(events, arrived, arrived).drop("timestamp")
    return decoded, events, silver


def _ingest(spark, topic, lake, tmp_path, **options):
    query = ingest.start_ingest(
        _stream(spark, topic), lake, str(tmp_path / "checkpoint"), SETTINGS, ONCE, **options
    )
    query.awaitTermination()
    return query


def test_ingest_fills_every_layer(spark, topic, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    query = _ingest(spark, topic, lake, tmp_path)
    decoded, events, silver = _expected(spark, topic)
    stamps = ["ingestion_timestamp", "batch_id"]
    assert same(
        lake.read(spark, "bronze").drop(*stamps),
        layers.bronze_rows(events).drop("ingestion_timestamp", "timestamp"),
    )
    assert same(
        lake.read(spark, "silver").drop(*stamps), silver.drop("ingestion_timestamp")
    )
    for table, rows in layers.gold_tables(silver).items():
        assert same(lake.read(spark, table), rows)
    reasons = decoded.select(msg.failure_reason(F.col("timestamp")).alias("reason"))
    assert rows_of(lake.read(spark, "dead_letter"), "failure_reason") == rows_of(
        reasons.filter("reason is not null")
    )
    assert rows_of(lake.read(spark, "late_events"), "event_id") == [("e90",)]
    observed = [p["observedMetrics"]["messages"] for p in query.recentProgress]
    assert sum(m["total"] for m in observed) == decoded.count()
    assert sum(m["invalid"] for m in observed) == 1


def test_a_replayed_batch_replaces_itself(spark, topic, tmp_path):
    lake = Lake(str(tmp_path / "lake"), DAYS)
    query = _ingest(spark, topic, lake, tmp_path)
    stored = {t: rows_of(lake.read(spark, t)) for t in schemas.TABLES}
    write = ingest.write_batch(lake, SETTINGS, query_id=str(query.id))
    for batch_id, rows in enumerate(_batches()):
        stamped = spark.createDataFrame(rows, schemas.MESSAGE).withColumn(
            "ingested_at", F.current_timestamp()
        )
        write(msg.decode(stamped), batch_id)
    drop = {"ingestion_timestamp", "failure_timestamp", "batch_id"}
    for table, rows in stored.items():
        again = lake.read(spark, table)
        kept = [c for c in again.columns if c not in drop]
        if table == "dead_letter":
            kept = ["raw_value", "kafka_offset", "failure_reason"]
        before = spark.createDataFrame(rows, again.schema) if rows else again
        assert same(again.select(kept), before.select(kept))


def test_restart_continues_where_it_stopped(spark, topic, tmp_path):
    lake = Lake(str(tmp_path / "lake"), DAYS)
    _ingest(spark, topic, lake, tmp_path)
    first = lake.read(spark, "silver").count()
    extra = [message(event("new", 30_200), 999, 30_200), message(event("e3", 60), 1000, 30_201)]
    messages_df(spark, extra).coalesce(1).write.mode("append").parquet(topic)
    _ingest(spark, topic, lake, tmp_path)
    silver = lake.read(spark, "silver")
    assert silver.count() == first + 1
    assert silver.groupBy("event_id").count().filter("count > 1").count() == 0


def test_errors_stop_the_query(spark, topic, tmp_path):
    class Broken(Lake):
        def append(self, rows, table, batch_id):
            raise OSError("no space")

    with pytest.raises(Exception, match="no space"):
        _ingest(spark, topic, Broken(str(tmp_path / "lake")), tmp_path)


def test_hours_are_refreshed_only_by_fitting_windows(spark, tmp_path):
    with pytest.raises(ValueError, match="divide the hour"):
        ingest.write_batch(Lake(str(tmp_path)), Settings(window_minutes=7))


def test_gold_alone_counts_each_event_or_lists_it_as_late(spark, topic, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    metrics.start_gold(
        _stream(spark, topic), lake, str(tmp_path / "checkpoint"), SETTINGS, ONCE
    ).awaitTermination()
    _, _, silver = _expected(spark, topic)
    in_time = silver.filter("event_id != 'e90'")
    for table, rows in layers.gold_tables(in_time).items():
        assert same(lake.read(spark, table), rows)
    assert rows_of(lake.read(spark, "late_events"), "event_id", "late_reason") == [("e90", "late")]
    counted = lake.read(spark, "traffic_analytics").agg(F.sum("visits")).first()[0]
    assert counted + 1 == silver.count()


def test_stream_dedup_spans_batches_and_reports_late_rows(spark, topic, tmp_path):
    stream = metrics.clean_stream(_stream(spark, topic), SETTINGS).select("event_id")
    rows, query = _collect(spark, stream, tmp_path, "dedup")
    _, _, silver = _expected(spark, topic)
    assert rows_of(rows) == rows_of(silver.filter("event_id != 'e90'"), "event_id")
    assert metrics.dropped_late_rows(query) == 1


def test_approximate_funnel_runs_in_update_mode(spark, topic, tmp_path):
    stream = metrics.clean_stream(_stream(spark, topic), SETTINGS)
    out = str(tmp_path / "updates")
    query = (
        windows.funnel_metrics_approx(stream)
        .writeStream.outputMode("update")
        .foreachBatch(lambda df, i: df.write.mode("append").parquet(out))
        .option("checkpointLocation", str(tmp_path / "updates-checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    rows = spark.read.schema(schemas.FUNNEL).parquet(out)
    _, _, silver = _expected(spark, topic)
    expected = windows.funnel_metrics(silver.filter("event_id != 'e90'"))
    assert rows.select("window_start").distinct().count() == expected.count()


def test_gap_sessions_of_stream_and_batch_agree(spark, topic, tmp_path):
    clean = metrics.clean_stream(_stream(spark, topic), SETTINGS)
    stream = sessions.gap_session_windows(clean)
    rows, _ = _collect(spark, stream, tmp_path, "gaps")
    _, _, silver = _expected(spark, topic)
    expected = sessions.gap_sessions(silver.filter("event_id != 'e90'"))
    newest = silver.agg(F.max("event_timestamp")).first()[0]
    closed = F.col("session_end") + F.expr("interval 30 minutes") <= F.lit(newest) - F.expr(
        "interval 60 minutes"
    )
    columns = ["user_id", "session_start", "session_end", "events"]
    assert same(rows.select(columns), expected.filter(closed).select(columns))


def test_late_rows(spark, topic):
    _, events, _ = _expected(spark, topic)
    dated = ops.parse_event_time(events.filter(ops.is_valid()))
    late = metrics.late_rows(dated, F.col("timestamp"))
    assert rows_of(late, "event_id") == [("e90",), ("e91",)]
    in_time = late.filter(in_range(F.col("event_timestamp"), F.col("timestamp")))
    assert rows_of(in_time, "event_id") == [("e90",)]


def test_serving_runs_on_the_written_lake(spark, topic, tmp_path):
    lake = Lake(str(tmp_path / "lake"), DAYS)
    _ingest(spark, topic, lake, tmp_path)
    lake.register_views(spark)
    funnel = spark.table("funnel_metrics")
    assert serving.live_metrics(funnel, "2024-03-01").first().total_events > 0
    sql = "SELECT count(DISTINCT event_id) FROM silver"
    assert spark.sql(sql).first()[0] == lake.read(spark, "silver").count()


def test_settings_read_the_environment():
    settings = Settings.from_env({"SPARK_WINDOW_INTERVAL": "10", "KAFKA_TOPIC_CLICKSTREAM": "t"})
    assert (settings.window, settings.topic) == ("10 minutes", "t")
    assert settings.watermark == "60 minutes"
    assert Settings.from_env({}).trigger == {"processingTime": "10 seconds"}


def _write(spark, lake, batches, query_id):
    """Run batches of (offset, (payload, minutes until arrival)) through the ingest function."""
    write = ingest.write_batch(lake, SETTINGS, query_id=query_id)
    for batch_id, rows in enumerate(batches):
        arrived = [message(payload, n, 60 * m) for n, (payload, m) in rows]
        batch = spark.createDataFrame(arrived, schemas.MESSAGE)
        write(msg.decode(batch.withColumn("ingested_at", F.current_timestamp())), batch_id)


def test_another_query_or_checkpoint_keeps_what_is_stored(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"), DAYS)
    first = [[(n, (event(f"a{n}", n), 1)) for n in range(5)]]
    second = [[(n, (event(f"b{n}", n), 2)) for n in range(3)]]
    _write(spark, lake, first, "one")
    _write(spark, lake, second, "two")
    _write(spark, lake, second, "two")
    for table in ("bronze", "silver"):
        ids = rows_of(lake.read(spark, table), "event_id")
        assert ids == [(f"a{n}",) for n in range(5)] + [(f"b{n}",) for n in range(3)]


def test_an_id_is_stored_once_whatever_time_its_copies_state(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"), DAYS)
    day = 24 * 60
    copies = [
        [(0, (event("x", 0), 1))],
        [(1, (event("x", 86_400), day + 1)), (2, (event("y", 86_400), day + 1))],
    ]
    _write(spark, lake, copies, "q")
    assert rows_of(lake.read(spark, "silver"), "event_id") == [("x",), ("y",)]
    assert rows_of(lake.read(spark, "bronze"), "event_id") == [("x",), ("x",), ("y",)]


def test_a_late_event_delivered_twice_is_listed_once(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"), DAYS)
    late = [[(0, (event("late", 0), 180))], [(1, (event("late", 0), 190))]]
    _write(spark, lake, late, "q")
    assert rows_of(lake.read(spark, "late_events"), "event_id") == [("late",)]
    assert rows_of(lake.read(spark, "silver"), "event_id") == [("late",)]
