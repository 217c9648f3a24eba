"""What micro-batches write, and in how many files and tasks."""

import threading
from contextlib import nullcontext
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from clickweave import catalog
from clickweave.session import BOUNDED_STATE, streaming_session
from clickweave.sinks.lake import DAYS, Lake, side_by_side
from clickweave.sources.messages import file_stream
from clickweave.streaming import ingest, metrics
from tests.helpers import event, message, messages_df

ONCE = {"availableNow": True}
DATA = "/root/testdata/sf0.001"


def _stream(spark, tmp_path):
    rows = [event(f"e{i}", i % 3 * 60, user_id=f"u{i % 40}") for i in range(200)]
    path = str(tmp_path / "topic")
    messages_df(spark, [message(r, i, 200) for i, r in enumerate(rows)]).write.parquet(path)
    return file_stream(streaming_session(spark), path)


def _files(lake, table):
    folders = {}
    for file in Path(lake.path(table)).rglob("*.parquet"):
        folders.setdefault(file.parent, []).append(file)
    return [len(files) for files in folders.values()]


def test_ingest_writes_one_file_per_small_folder(spark, tmp_path):
    stream, lake = _stream(spark, tmp_path), Lake(str(tmp_path / "lake"), DAYS)
    query = ingest.start_ingest(stream, lake, str(tmp_path / "checkpoint"), trigger=ONCE)
    query.awaitTermination()
    assert lake.read(spark, "silver").count() == 200
    for table in ("bronze", "silver", "funnel_metrics_parts", "traffic_analytics_parts"):
        assert _files(lake, table) == [1], table


def test_gold_writes_one_file_per_small_folder(spark, tmp_path):
    stream, lake = _stream(spark, tmp_path), Lake(str(tmp_path / "lake"), DAYS)
    metrics.start_gold(stream, lake, str(tmp_path / "checkpoint"), trigger=ONCE).awaitTermination()
    for table in ("funnel_metrics_parts", "product_performance_parts", "traffic_analytics_parts"):
        assert _files(lake, table) in ([1], []), table
    assert _files(lake, "funnel_metrics_parts") == [1]


def test_gold_counts_the_earliest_of_the_copies_in_a_batch_however_read(spark, tmp_path):
    path, lake = str(tmp_path / "topic"), Lake(str(tmp_path / "lake"), DAYS)
    rows = [event("e1", 7200), event("e2", 30), event("e1", 60)]
    messages = messages_df(spark, [message(r, i, 7300) for i, r in enumerate(rows)])
    messages.coalesce(1).write.parquet(path)
    stream = file_stream(streaming_session(spark), path)
    metrics.start_gold(stream, lake, str(tmp_path / "checkpoint"), trigger=ONCE).awaitTermination()
    counted = lake.read(spark, "traffic_analytics").select("window_start", "visits").collect()
    assert [tuple(r) for r in counted] == [("2024-03-01 10:00:00", 2)]


def test_deliveries_of_many_files_are_batches_in_order(spark, tmp_path):
    base, seen = str(tmp_path), []

    def run(stream):
        def note(batch, n):
            seen.append((n, batch.count()))

        writer = stream.writeStream.foreachBatch(note).trigger(**ONCE)
        query = writer.option("checkpointLocation", f"{base}/checkpoint").start()
        query.awaitTermination()
        return query

    topic, _ = catalog._topic_in_three(spark, DATA, base, run)
    rows = [spark.read.parquet(f"{topic}/delivery={k}").count() for k in range(3)]
    assert seen == list(enumerate(rows)) and min(rows) > 0
    assert all(len(list(Path(topic, f"delivery={k}").glob("*.parquet"))) > 1 for k in range(3))


def test_writes_side_by_side_all_run_and_raise():
    both = threading.Barrier(2, timeout=20)
    side_by_side([both.wait, both.wait])

    def fail():
        raise OSError("no space")

    done = []
    with pytest.raises(OSError, match="no space"):
        side_by_side([fail, lambda: done.append(1)])
    assert done == [1]


def test_a_log_of_one_file_is_streamed_by_all_tasks(spark, tmp_path):
    tasks = []

    def note(batch, n):
        tasks.append(batch.select(F.spark_partition_id()).distinct().count())

    log = catalog._log_stream(streaming_session(spark), DATA)
    writer = log.writeStream.foreachBatch(note).trigger(**ONCE)
    writer.option("checkpointLocation", str(tmp_path / "checkpoint")).start().awaitTermination()
    assert tasks == [4]


def _ingested(spark, tmp_path, lake, seconds):
    """A run of ingest from its checkpoint, after one more file of the same 200 ids and a new one."""
    rows = [event(f"e{i}", 1) for i in range(200)] + [event(f"n{seconds}", 1)]
    path = str(tmp_path / "topic")
    messages = messages_df(spark, [message(r, i, seconds) for i, r in enumerate(rows)])
    messages.coalesce(1).write.mode("append").parquet(path)
    session = streaming_session(spark)
    before = {key: session.conf.get(key, None) for key in BOUNDED_STATE}
    checkpoint = str(tmp_path / "checkpoint")
    query = ingest.start_ingest(file_stream(session, path), lake, checkpoint, trigger=ONCE)
    query.awaitTermination()
    assert before == {key: session.conf.get(key, None) for key in BOUNDED_STATE}
    return query.lastProgress["stateOperators"][0]


def test_ids_of_ingest_leave_memory_when_a_batch_is_committed(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"), DAYS)
    state = _ingested(spark, tmp_path, lake, 100)
    assert state["numRowsTotal"] == 201
    # Not committed to a file, they would be in the stores' write buffers.
    assert state["customMetrics"]["rocksdbSstFileSize"] > 0
    state = _ingested(spark, tmp_path, lake, 200)
    assert state["numRowsTotal"] == 202 and lake.read(spark, "silver").count() == 202


def test_ids_kept_before_state_was_bounded_are_known(spark, tmp_path, monkeypatch):
    lake = Lake(str(tmp_path / "lake"), DAYS)
    with monkeypatch.context() as patch:
        patch.setattr(ingest, "bounded_state", lambda session: nullcontext())
        state = _ingested(spark, tmp_path, lake, 100)
    assert state["customMetrics"]["rocksdbSstFileSize"] == 0
    state = _ingested(spark, tmp_path, lake, 200)
    assert state["customMetrics"]["rocksdbSstFileSize"] > 0
    assert state["numRowsTotal"] == 202 and lake.read(spark, "silver").count() == 202
