"""Gold from parts, and ids across batches: against batch metrics, with replays and late events."""

import random

import pytest
from pyspark.sql import functions as F

from clickweave import schemas
from clickweave.config import Settings
from clickweave.operators import messages as msg
from clickweave.operators import sessions, windows
from clickweave.plans import layers
from clickweave.session import streaming_session
from clickweave.sinks.lake import DAYS, GOLD, HOURS, Lake, parts_table
from clickweave.sources.messages import file_stream
from clickweave.streaming import ingest, metrics
from tests.helpers import event, message, messages_df, rows_of, same, silver_df

SETTINGS = Settings()
ONCE = {"availableNow": True}
HOUR = 3600
DAY = 24 * HOUR


class Watched(Lake):
    """Notes which stored tables are read."""

    seen: list = []

    def _stored(self, spark, table, evolved=False):
        self.seen.append(table)
        return super()._stored(spark, table, evolved)


def _some_events(n: int, span: int, seed: int = 7) -> list[dict]:
    rng = random.Random(seed)
    kinds = ["page_view", "product_view", "add_to_cart", "purchase", "search", "begin_checkout"]
    return [
        event(
            f"e{i}",
            rng.randrange(span),
            event_type=rng.choice(kinds),
            user_id=f"u{rng.randrange(9)}",
            session_id=f"s{rng.randrange(14)}",
            product_id=rng.choice([None, "p1", "p2"]),
            country=rng.choice(["Germany", "France", None]),
            cart_value=rng.choice([0.1, 2.5, 10.0]),
        )
        for i in range(n)
    ]


def _gold(spark, lake):
    return {table: lake.read(spark, table) for table in GOLD}


def _add(spark, lake, rows, key, clock, **options):
    at = f"2024-03-01 {10 + clock // HOUR:02d}:{clock % HOUR // 60:02d}:00"
    return ingest.add_gold(lake, silver_df(spark, rows), key, at, SETTINGS, **options)


@pytest.mark.parametrize(("partitions", "n"), [(HOURS, 6), (DAYS, 20)])
def test_parts_of_many_batches_equal_batch_gold(spark, tmp_path, partitions, n):
    """Batches out of order in time, some run twice, one long after its hours were settled."""
    lake = Lake(str(tmp_path), partitions)
    rows = _some_events(120, 4 * HOUR)
    batches = [rows[k::n] for k in range(n)]
    for k, batch in enumerate(batches):
        for _ in range(2 if k % 5 == 0 else 1):
            _add(spark, lake, batch, f"q-{k}", 5 * HOUR * k // n)
    _add(spark, lake, batches[3], "q-3", 15 * HOUR // n)
    assert lake.settled(spark) == ("2024-03-01 13:00:00" if n == 6 else "2024-03-01 00:00:00")
    for table, expected in layers.gold_tables(silver_df(spark, rows)).items():
        assert same(lake.read(spark, table), expected)


def test_a_late_event_changes_its_window_only(spark, tmp_path):
    lake = Lake(str(tmp_path))
    early = [event("a", 60), event("b", 400, user_id="u2"), event("c", HOUR + 60)]
    _add(spark, lake, early, "q-0", 2 * HOUR)
    _add(spark, lake, [event("d", 3 * HOUR)], "q-1", 4 * HOUR)
    assert lake.settled(spark) == "2024-03-01 13:00:00"
    before = rows_of(lake.read(spark, "funnel_metrics"))
    _add(spark, lake, [event("e", 70, user_id="u3")], "q-2", 4 * HOUR)
    after = rows_of(lake.read(spark, "funnel_metrics"))
    changed = [(a, b) for a, b in zip(before, after, strict=True) if a != b]
    assert len(changed) == 1
    names = schemas.FUNNEL.fieldNames()
    old, new = (dict(zip(names, row, strict=True)) for row in changed[0])
    assert (old["page_views"], new["page_views"]) == (1, 2)
    assert (old["unique_users"], new["unique_users"]) == (1, 2)
    assert new["window_start"] == "2024-03-01 10:00:00"


def test_a_batch_reads_no_events_and_no_parts_of_open_time(spark, tmp_path):
    lake = Watched(str(tmp_path))
    for k in range(3):
        Watched.seen = []
        _add(spark, lake, [event(f"x{k}", HOUR + k)], f"q-{k}", HOUR + 60 * k)
        assert set(Watched.seen) <= ({"settled"} if k else {"settled", *map(parts_table, GOLD)})
    Watched.seen = []
    _add(spark, lake, [event("y", 2 * HOUR)], "q-9", 3 * HOUR)  # settles the hours before
    assert set(Watched.seen) == {"settled", *map(parts_table, GOLD)}
    assert "silver" not in Watched.seen


def test_diverted_events_stay_diverted_when_their_batch_runs_again(spark, tmp_path):
    lake = Lake(str(tmp_path))
    _add(spark, lake, [event("a", 0)], "q-0", 2 * HOUR, divert=True)
    batch = [event("b", 0), event("c", 90 * 60)]
    for _ in range(2):  # the batch settles 11:00 to 12:00 itself; its own event of then still counts
        late = _add(spark, lake, batch, "q-1", 3 * HOUR, divert=True)
        assert rows_of(late, "event_id") == [("b",)]
        funnel = lake.read(spark, "funnel_metrics")
        assert rows_of(funnel, "window_start", "page_views") == [
            ("2024-03-01 10:00:00", 1),
            ("2024-03-01 11:30:00", 1),
        ]


def test_sliding_windows_from_panes(spark):
    rows = silver_df(spark, _some_events(300, 3 * HOUR))
    panes = windows.funnel_metrics_panes(rows, "15 minutes", "5 minutes")
    assert same(panes, windows.funnel_metrics(rows, "15 minutes", "5 minutes"))
    plan = panes._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.rindex("Aggregate [") :]
    assert "Expand" not in below, "events are not copied into windows"


# --- ids ------------------------------------------------------------------------------------------


def _deliver(spark, topic, *rows):
    messages_df(spark, list(rows)).coalesce(1).write.mode("append").parquet(topic)


def _run(spark, topic, lake, checkpoint):
    stream = file_stream(streaming_session(spark), topic, max_files_per_trigger=1)
    ingest.start_ingest(stream, lake, checkpoint, SETTINGS, ONCE).awaitTermination()


def test_ids_are_known_after_30_days_restarts_and_new_checkpoints(spark, tmp_path):
    topic, lake = str(tmp_path / "topic"), Watched(str(tmp_path / "lake"), DAYS)
    late = 30 * DAY
    # The first copy of `r` is too old when it arrives, so it is rejected and a good one counts.
    rejected = message(event("r", -9 * DAY), 2, 10)
    _deliver(spark, topic, message(event("a", 0), 0, 5), message(event("b", 1), 1, 6), rejected)
    copy = message(event("a", late), 3, late + 5)
    _deliver(spark, topic, copy, message(event("r", late), 4, late + 6))
    _run(spark, topic, lake, str(tmp_path / "one"))
    assert rows_of(lake.read(spark, "silver"), "event_id") == [("a",), ("b",), ("r",)]

    _deliver(spark, topic, message(event("b", late + 9), 5, late + 9), message(event("c", late), 6, late))
    Watched.seen = []
    _run(spark, topic, lake, str(tmp_path / "one"))
    assert "silver" not in Watched.seen
    ids = [("a",), ("b",), ("c",), ("r",)]
    assert rows_of(lake.read(spark, "silver"), "event_id") == ids
    times = rows_of(lake.read(spark, "silver"), "event_id", "event_time")
    assert dict(times)["a"] == event("a", 0)["event_time"]

    # A new checkpoint starts at the first message: ids come from silver, once.
    _deliver(spark, topic, message(event("d", late), 7, late + 20), message(event("d", late), 8, late + 21))
    Watched.seen = []
    _run(spark, topic, lake, str(tmp_path / "two"))
    assert Watched.seen.count("silver") == 1
    silver = lake.read(spark, "silver")
    assert rows_of(silver, "event_id") == sorted([*ids, ("d",)])
    for table, rows in layers.gold_tables(silver).items():
        assert same(lake.read(spark, table), rows)


def test_gold_alone_sees_each_id_once(spark, tmp_path):
    topic, lake = str(tmp_path / "topic"), Lake(str(tmp_path / "lake"))
    late = 3 * DAY
    _deliver(spark, topic, message(event("a", 0), 0, 5), message(event("a", 1), 1, 6))
    _deliver(spark, topic, message(event("a", late), 2, late), message(event("b", late), 3, late))
    _deliver(spark, topic, message(event("c", 0), 4, late + 1), message(event("c", 0), 5, late + 2))
    stream = file_stream(streaming_session(spark), topic, max_files_per_trigger=1)
    query = metrics.start_gold(stream, lake, str(tmp_path / "checkpoint"), SETTINGS, ONCE)
    query.awaitTermination()
    traffic = lake.read(spark, "traffic_analytics")
    assert traffic.agg(F.sum("visits")).first()[0] == 2
    assert rows_of(lake.read(spark, "late_events"), "event_id", "late_reason") == [("c", "late")]


def test_a_batch_outside_of_a_query_needs_its_id(spark, tmp_path):
    rows = messages_df(spark, [message(event("a", 0), 0)]).withColumn(
        ingest.INGESTED, F.current_timestamp()
    )
    with pytest.raises(ValueError, match="query_id"):
        ingest.write_batch(Lake(str(tmp_path)), SETTINGS)(msg.decode(rows), 0)


def test_bronze_with_every_row_and_the_payload(spark, tmp_path):
    topic, lake = str(tmp_path / "topic"), Lake(str(tmp_path / "lake"), DAYS)
    new = message({**event("a", 0), "coupon": {"code": "SAVE"}}, 0, 5)
    _deliver(spark, topic, new, message(event("", 1), 1, 6), message("{bad", 2, 7))
    stream = file_stream(streaming_session(spark), topic)
    ingest.start_ingest(
        stream, lake, str(tmp_path / "c"), SETTINGS, ONCE, every_row=True, keep_payload=True
    ).awaitTermination()
    bronze = lake.read(spark, "bronze", evolved=True)
    code = F.variant_get("payload", "$.coupon.code", "string").alias("code")
    assert rows_of(bronze.select("event_id", "is_valid", code)) == [
        ("", False, None),
        ("a", True, "SAVE"),
    ]
    assert "payload" not in lake.read(spark, "bronze").columns
    assert rows_of(lake.read(spark, "silver"), "event_id") == [("a",)]


def test_session_parts_merge_to_the_rollup_of_all_events(spark, tmp_path):
    """Batches out of order, one of them run again; ties in time are settled by id."""
    lake = Lake(str(tmp_path), DAYS)
    kinds = ["page_view", "category_view", "search", "purchase", "product_view"]
    rows = [
        event(
            f"e{i % 97:03d}-{i}",
            i % 40,
            event_type=kinds[i % 5],
            session_id=f"s{i % 3 * (i % 2)}",
            user_id=f"u{i % 4}",
            page=["/", "/sale", None][i % 3],
            product_id=[None, "p1", "p2"][i % 7 % 3],
            category=["toys", "books", None][i % 11 % 3],
        )
        for i in range(150)
    ]
    for k in (0, 3, 1, 2, 3):
        lake.add_session_parts(silver_df(spark, rows[k::4]), f"q-{k}")
    whole = silver_df(spark, rows)
    expected = sessions.session_rollup(whole)
    assert same(lake.session_rollup(spark), expected)
    parts = sessions.session_parts(whole)
    assert same(sessions.rollup_of(parts), expected)
    plan = parts._jdf.queryExecution().executedPlan().toString()
    for node in plan.split("\n"):
        if "SortAggregate" in node and "partial_" in node:
            assert "event_timestamp" not in node, "only category views are sorted"
