"""How often the ordered stream operators go to their state, and how a delivery's files arrive."""

import random

import pandas as pd
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import TimerValues

from clickweave import catalog
from clickweave.operators import sessions as batch
from clickweave.session import streaming_session
from clickweave.streaming import metrics
from clickweave.streaming import sessions as stream
from tests.helpers import same


class _State:
    def __init__(self):
        self.value, self.calls = None, 0

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value

    def clear(self):
        self.calls += 1
        self.value = None


class _Map(dict):
    calls = 0

    def getValue(self, key):
        self.calls += 1
        return self[key]

    def updateValue(self, key, value):
        self.calls += 1
        self[key] = value

    def removeKey(self, key):
        self.calls += 1
        del self[key]


class _Handle:
    def __init__(self):
        self.state, self.map, self.timers = _State(), _Map(), set()

    def getValueState(self, name, schema):
        return self.state

    def getMapState(self, name, key, value):
        return self.map

    def registerTimer(self, at):
        self.timers.add(at)


def _events(sessions, times, kind="page_view"):
    return [
        Row(session_id=f"s{s}", at=t, event_id=f"{s}-{t}", event_type=kind, amount=1.0 * t, quantity=1, copies=1)
        for t in times
        for s in range(sessions)
    ]


def test_a_group_of_sessions_is_read_and_written_once():
    handle, steps = _Handle(), stream._Steps()
    steps.init(handle)
    out = list(steps.handleInputRows((1,), iter(_events(100, [2, 1])), None))
    assert len(out) == 200 and handle.state.calls == 2
    out = list(steps.handleInputRows((1,), iter(_events(100, [3], "search")), None))
    assert {r.from_type for r in out} == {"page_view"} and handle.state.calls == 4


def test_shallow_carts_need_no_entries_and_deep_ones_pop_them():
    handle, cart = _Handle(), stream._Cart()
    cart.init(handle)
    list(cart.handleInputRows((1,), iter(_events(3, range(1, 41), "add_to_cart")), None))
    assert handle.state.calls == 2 and len(handle.map) == 3 * (40 - stream.TOP_LEVELS)
    removed = list(cart.handleInputRows((1,), iter(_events(3, range(41, 82), "remove_from_cart")), None))
    first = [r for r in removed if r.session_id == "s0"]
    assert [r.amount for r in first] == [-float(t) for t in range(40, 0, -1)] + [0.0]
    assert first[-1].items == 0 and first[-1].cart_value == 0.0 and not handle.map


def test_gap_sessions_of_a_group_close_on_their_own_timers():
    handle, gaps = _Handle(), stream._Gaps(1800 * 10**6, "bigint")
    gaps.init(handle)
    rows = [
        Row(user_id=u, first_at=at * 10**6, last_at=at * 10**6, events=1)
        for u, at in [(1, 0), (2, 100), (1, 1700), (3, 9000), (None, 50)]
    ]
    assert list(gaps.handleInputRows((1,), iter(rows), None)) == [] and handle.state.calls == 2

    class _Info:
        def __init__(self, at):
            self.getExpiryTimeInMs = lambda: at

    closed = [
        (r.user_id, r.first_at // 10**6, r.last_at // 10**6, r.events)
        for at in sorted(handle.timers)
        for r in gaps.handleExpiredTimer((1,), None, _Info(at))
    ]
    assert sorted(closed, key=repr) == [(1, 0, 1700, 2), (2, 100, 100, 1), (3, 9000, 9000, 1), (None, 50, 50, 1)]
    assert handle.state.value is None


def _bucket(user, at, events=1):
    return Row(user_id=user, first_at=at * 10**6, last_at=at * 10**6, events=events)


class _Expiry:
    def __init__(self, at):
        self.getExpiryTimeInMs = lambda: at


def test_gap_sessions_that_are_over_need_no_state_and_no_timer():
    handle, gaps = _Handle(), stream._Gaps(1800 * 10**6, "bigint")
    gaps.init(handle)
    rows = [_bucket(u, u * 1800) for u in range(100)]
    out = list(gaps.handleInputRows((1,), iter(rows), TimerValues(-1, 10**9)))
    assert sorted(r.user_id for r in out) == list(range(100))
    assert handle.state.value is None and handle.state.calls == 1 and not handle.timers
    # At the watermark itself a session is over, a millisecond before it is not.
    rows = [_bucket(1, 0), _bucket(2, 1800)]
    out = list(gaps.handleInputRows((1,), iter(rows), TimerValues(-1, 3_600_000)))
    assert [r.user_id for r in out] == [1] and handle.timers == {5_400_000}
    assert [entry[0] for entry in handle.state.value[0]] == [2]


def test_one_timer_of_a_batch_closes_all_that_is_due_and_writes_once():
    handle, gaps = _Handle(), stream._Gaps(1800 * 10**6, "bigint")
    gaps.init(handle)
    rows = [_bucket(u, u * 1800) for u in range(50)]
    assert not list(gaps.handleInputRows((1,), iter(rows), TimerValues(-1, 0)))
    timers, handle.state.calls = sorted(handle.timers), 0
    now = timers[39]
    closed = [
        [r.user_id for r in gaps.handleExpiredTimer((1,), TimerValues(-1, now), _Expiry(at))]
        for at in timers[:40]
    ]
    assert closed == [list(range(40)), *[[]] * 39]
    assert handle.state.calls == 40 + 1  # a read per timer, one write
    assert [entry[0] for entry in handle.state.value[0]] == list(range(40, 50))


def _buckets(batches):
    """Buckets of some users, one of them null, over several batches in the order of time."""
    rng, users = random.Random(8), [None, *[str(2**53 + u) for u in range(6)]]
    rows = sorted((rng.randrange(400) * 1800 + rng.randrange(1800), u) for u in range(7) for _ in range(90))
    size = -(-len(rows) // batches)
    return [
        [_bucket(users[u], at, 1 + at % 3) for at, u in rows[k * size : (k + 1) * size]]
        for k in range(batches)
    ]


def test_frames_of_buckets_give_the_sessions_of_rows_and_few_rows_meet_the_state(monkeypatch):
    rows_gaps, frame_gaps = stream._Gaps(1800 * 10**6, "string"), stream._GapFrames(1800 * 10**6)
    for gaps in (rows_gaps, frame_gaps):
        gaps.init(_Handle())
    met, join = [], stream._joined
    monkeypatch.setattr(stream, "_joined", lambda *args: met.append(join(*args)) or met[-1])
    for rows in _buckets(5):
        now = TimerValues(-1, rows[-1].first_at // 1000 - 3_600_000)
        wanted = list(rows_gaps.handleInputRows((1,), iter(rows), now))
        shuffled = pd.DataFrame(random.Random(1).sample(rows, len(rows)), columns=stream._SPAN)
        frames = frame_gaps.handleInputRows((1,), iter([shuffled[:50], shuffled[50:]]), now)
        found = [tuple(r) for frame in frames for r in frame[stream._SPAN].to_numpy().tolist()]
        assert sorted(found, key=repr) == sorted((tuple(r) for r in wanted), key=repr)
        assert len(met[-1][1]) <= 2 * 7 < len(met[-1][0])
        assert frame_gaps.handle.timers == rows_gaps.handle.timers
    at = max(frame_gaps.handle.timers)
    last = [
        sorted(tuple(r) for r in pd.concat(frame_gaps.handleExpiredTimer((1,), None, _Expiry(at))).to_numpy()),
        sorted(tuple(r) for r in rows_gaps.handleExpiredTimer((1,), None, _Expiry(at))),
    ]
    assert last[0] == last[1] != []


def test_gap_sessions_of_null_and_long_users(spark, tmp_path):
    rng, path = random.Random(2), str(tmp_path / "events")
    users = [None, 2**53, 2**53 + 1, -(2**62) - 1, 0]
    schema = "user_id bigint, seconds bigint"
    for k in range(3):
        part = [(rng.choice(users), k * 20_000 + rng.randrange(20_000)) for _ in range(60)]
        rows = spark.createDataFrame([*part, (7, 90_000 * (k == 2))], schema)
        rows.select("user_id", F.timestamp_seconds("seconds").alias("event_timestamp")).coalesce(
            1
        ).write.mode("append").parquet(path)
    events = spark.read.parquet(path)
    stored = streaming_session(spark).readStream.schema(events.schema).parquet(path)
    found = stream.gap_sessions(stored.withWatermark("event_timestamp", "60 minutes"))
    out = str(tmp_path / "out")
    metrics.append_to(found, out, str(tmp_path / "checkpoint"), catalog.ONCE).awaitTermination()
    found = spark.read.schema(found.schema).parquet(out)
    columns = ["user_id", "session_start", "session_end", "events"]
    wanted = batch.gap_sessions(events).select(columns)
    wanted = wanted.filter(F.col("session_end") < F.timestamp_seconds(F.lit(90_000)))
    assert wanted.count() > 50 and wanted.filter("user_id IS NULL").count() > 5
    assert same(found, wanted)


def test_a_delivery_of_many_files_is_one_batch(spark, tmp_path):
    folder, batches = str(tmp_path / "log"), []
    deliveries = [spark.range(k * 100, k * 100 + 100).repartition(4) for k in range(2)]
    session = streaming_session(spark)
    session.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")

    def start():
        reader = session.readStream.schema("id bigint").option("maxFilesPerTrigger", catalog.ALL_FILES)
        rows = reader.parquet(folder).writeStream.trigger(**catalog.ONCE)
        rows = rows.option("checkpointLocation", str(tmp_path / "checkpoint"))
        return rows.foreachBatch(
            lambda batch, n: batches.append((n, sorted(r.id for r in batch.collect())))
        ).start()

    catalog._deliver(deliveries, folder, start)
    assert batches == [(0, list(range(100))), (1, list(range(100, 200)))]
