"""Ordered session operators on a stream against their batch forms, on shuffled micro-batches."""

import random

import pytest
from pyspark.sql import functions as F

from clickweave.operators import sessions as batch
from clickweave.session import streaming_session
from clickweave.streaming import metrics
from clickweave.streaming import sessions as stream
from tests.helpers import event, same, silver_df

ONCE = {"availableNow": True}
DELAY = "60 minutes"


def _rows() -> list[tuple[int, dict]]:
    """Events of five sessions with ties in time, one of them with half of all events."""
    rng = random.Random(11)
    kinds = ["page_view", "search", "product_view", "add_to_cart", "remove_from_cart", "purchase"]
    rows = []
    for i in range(240):
        seconds = i * 40 + rng.choice([0, 0, 0.25, 0.5])
        session = "s0" if i % 2 else f"s{rng.randrange(1, 5)}"
        kind = rng.choice(kinds)
        pieces = rng.choice([1, 2, 3, None]) if kind != "remove_from_cart" else -1
        changes = {"event_type": kind, "price": rng.choice([0.5, 3.25, 10.0]), "quantity": pieces}
        rows.append((seconds, event(f"e{i:03d}", seconds, session_id=session, **changes)))
    return rows


@pytest.fixture
def folder(spark, tmp_path):
    """Six files whose events are up to 50 minutes out of order, within and across files."""
    rng = random.Random(3)
    rows = sorted(_rows(), key=lambda r: r[0] + rng.randrange(50 * 60))
    size = len(rows) // 6
    path = str(tmp_path / "events")
    for k in range(6):
        part = [row for _, row in rows[k * size : (k + 1) * size]]
        silver_df(spark, part).coalesce(1).write.mode("append").parquet(path)
    return path


def _streamed(spark, folder, tmp_path, operator):
    sibling = streaming_session(spark)
    schema = spark.read.parquet(folder).schema
    reader = sibling.readStream.schema(schema).option("maxFilesPerTrigger", 1)
    rows = operator(reader.parquet(folder).withWatermark("event_timestamp", DELAY))
    out = str(tmp_path / "out")
    metrics.append_to(rows, out, str(tmp_path / "checkpoint"), ONCE).awaitTermination()
    return spark.read.schema(rows.schema).parquet(out)


def _due(spark, folder, rows, kinds="true"):
    """Rows that the watermark of the events that reach the operator has passed."""
    seen = spark.read.parquet(folder).filter(kinds)
    newest = seen.agg(F.max("event_timestamp")).first()[0]
    return rows.filter(F.col("event_timestamp") < F.lit(newest) - F.expr(f"interval {DELAY}"))


def test_steps_of_shuffled_batches(spark, folder, tmp_path):
    expected = _due(spark, folder, batch.session_steps(spark.read.parquet(folder)))
    found = _streamed(spark, folder, tmp_path, stream.session_steps)
    assert expected.count() > 100
    assert same(found, expected)
    assert same(batch.matrix_of(found), batch.matrix_of(expected))
    assert same(batch.illegal_of(found), batch.illegal_of(expected))


def test_cart_of_shuffled_batches_pops_across_batches(spark, folder, tmp_path):
    carts = "event_type IN ('add_to_cart', 'purchase', 'remove_from_cart')"
    expected = _due(spark, folder, batch.running_cart(spark.read.parquet(folder)), carts)
    found = _streamed(spark, folder, tmp_path, stream.running_cart)
    assert expected.filter("event_type = 'remove_from_cart' AND amount < 0").count() > 5
    assert same(found.select(*expected.columns), expected)


def test_illegal_steps_come_out_of_the_stream(spark, folder, tmp_path):
    expected = _due(spark, folder, batch.session_steps(spark.read.parquet(folder)))
    found = _streamed(
        spark, folder, tmp_path, lambda rows: batch.illegal_of(stream.session_steps(rows))
    )
    assert same(found, batch.illegal_of(expected))


def _visits() -> list[dict]:
    """Events over two days, a third of them of one user; many pauses near the gap's length."""
    rng = random.Random(5)
    rows, at = [], {}
    for i in range(400):
        user = "hot" if i % 3 == 0 else f"u{rng.randrange(8)}"
        pause = rng.choice([60, 600, 1700, 1799, 1800, 1801, 1900, 4000])
        at[user] = at.get(user, rng.randrange(900)) + (pause // 4 if user == "hot" else pause)
        rows.append((at[user], event(f"v{i}", at[user], user_id=user, session_id="s")))
    rows.append((200_000, event("last", 200_000, user_id="far")))
    return [row for _, row in sorted(rows, key=lambda r: r[0] + rng.randrange(40 * 60))]


def test_gap_sessions_from_buckets(spark, tmp_path):
    rows = _visits()
    path = str(tmp_path / "events")
    for k in range(5):
        part = silver_df(spark, rows[k * 81 : (k + 1) * 81])
        part.coalesce(1).write.mode("append").parquet(path)
    all_rows = spark.read.parquet(path)
    assert all_rows.count() == len(rows)
    found = _streamed(spark, path, tmp_path, stream.gap_sessions)
    columns = ["user_id", "session_start", "session_end", "events"]
    expected = batch.gap_sessions(all_rows).select(columns).filter("user_id != 'far'")
    assert expected.count() > 60
    assert same(found, expected)


def test_a_busy_user_spreads_over_buckets(spark):
    """A user with a third of all events leaves the largest share of the first shuffle near even."""
    users = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 500)
    at = (F.lit(1_700_000_000) + F.col("id") * 37).cast("timestamp")
    rows = spark.range(30_000).select(users.alias("user_id"), at.alias("event_timestamp"))
    bucket = F.window("event_timestamp", "30 minutes").alias("bucket")
    buckets = rows.groupBy(bucket, "user_id").agg(F.count(F.lit(1)).alias("n"))
    shares = buckets.groupBy(F.pmod(F.hash("bucket", "user_id"), F.lit(8)).alias("task"))
    sizes = sorted(r["events"] for r in shares.agg(F.sum("n").alias("events")).collect())
    assert len(sizes) == 8 and sizes[-1] < 2 * sizes[4]
    hot = buckets.filter("user_id = -1").count()
    assert hot < rows.filter("user_id = -1").count() / 10
