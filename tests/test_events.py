from datetime import datetime

from pyspark.sql import functions as F

from clickweave import schemas
from clickweave.operators import events as ops
from tests.helpers import event, events_df, rows_of


def test_valid_and_invalid_cover_the_input(spark):
    rows = [
        event("a"),
        event("b", event_type="teleport"),
        event("c", event_type=None),
        event("", page="/x"),
        event(None),
        event("f", user_id=None),
        event("g", session_id=None),
        event("h", user_id=""),
    ]
    events = events_df(spark, rows + [rows[1]])
    valid, invalid = ops.split_valid(events)
    assert rows_of(valid, "event_id") == [("a",), ("h",)]
    assert invalid.count() == 6
    assert rows_of(invalid) == rows_of(events.subtract(valid))
    assert rows_of(valid.union(invalid)) == rows_of(events.distinct())


def test_strict_validation(spark):
    rows = [
        event("a"),
        event("b", page=""),
        event("c", page=None),
        event("d", event_time=""),
        event("e", user_id=""),
        event("f", session_id=""),
        event("g", event_type="teleport"),
        event(None),
    ]
    checked = events_df(spark, rows).select("event_id", ops.is_strictly_valid().alias("ok"))
    assert [r.event_id for r in checked.filter("ok").collect()] == ["a"]
    assert checked.filter("ok is null").count() == 0


def test_every_event_type_is_valid(spark):
    events = events_df(spark, [event(t, event_type=t) for t in schemas.EVENT_TYPES])
    assert events.filter(ops.is_valid()).count() == 10


def test_flags(spark):
    events = events_df(
        spark, [event(t, event_type=t) for t in schemas.EVENT_TYPES] + [event("x", event_type=None)]
    )
    flagged = ops.add_event_flags(events)

    def with_flag(name):
        return {r.event_id for r in flagged.filter(name).collect()}

    assert with_flag("is_purchase") == {"purchase"}
    assert with_flag("is_cart_add") == {"add_to_cart"}
    assert with_flag("is_page_view") == {"page_view"}
    assert with_flag("is_checkout") == {"begin_checkout", "payment", "purchase"}
    assert with_flag("is_bounce") == set()
    assert flagged.filter("event_id = 'x' and is_purchase is null").count() == 1


def test_time_columns(spark):
    events = ops.parse_event_time(events_df(spark, [event("a"), event("b", event_time="bad")]))
    dated = ops.add_date_columns(ops.add_partition_columns(events))
    picked = ["year", "month", "day", "hour", "event_hour"]
    assert rows_of(dated.filter("event_id = 'a'"), *picked) == [(2024, 3, 1, 10, 10)]
    assert dated.filter("event_id = 'b' and year is null and event_date is null").count() == 1


def test_range_is_inclusive_and_drops_undated(spark):
    day = 86_400
    rows = [
        event("oldest", -7 * day),
        event("too_old", -7 * day - 1),
        event("newest", day),
        event("ahead", day + 1),
        event("undated", event_time="bad"),
        event("ancient", event_time="2020-01-01T00:00:00Z"),
        event("future", event_time="2099-12-31T23:59:59Z"),
    ]
    as_of = F.lit(datetime(2024, 3, 1, 10))
    kept = ops.within_range(ops.parse_event_time(events_df(spark, rows)), as_of)
    assert rows_of(kept, "event_id") == [("newest",), ("oldest",)]


def test_range_defaults_to_now(spark):
    events = events_df(spark, [event("past")]).unionByName(
        events_df(spark, [event("now")]).withColumn(
            "event_time", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")
        )
    )
    kept = ops.within_range(ops.parse_event_time(events))
    assert rows_of(kept, "event_id") == [("now",)]


def test_dedup_keeps_one_row_per_id_whatever_the_partitioning(spark):
    rows = [event(f"e{i % 7}", seconds=i, page=f"/{i}") for i in range(50)]
    events = ops.parse_event_time(events_df(spark, rows))
    first = rows_of(ops.deduplicate(events), "event_id", "page")
    assert first == [(f"e{i}", f"/{i}") for i in range(7)]
    assert rows_of(ops.deduplicate(events.repartition(3, "page")), "event_id", "page") == first


def test_dedup_ties_are_broken_by_content(spark):
    rows = [event("a", page=f"/{i}") for i in range(20)]
    events = ops.parse_event_time(events_df(spark, rows))
    kept = {rows_of(ops.deduplicate(events.repartition(n)), "page")[0] for n in (1, 2, 5)}
    assert len(kept) == 1


def test_dedup_limits_copies_before_the_shuffle(spark):
    events = ops.parse_event_time(events_df(spark, [event("a")]))
    plan = ops.deduplicate(events)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_empty_and_single_batches(spark):
    empty = ops.parse_event_time(events_df(spark, []))
    assert ops.deduplicate(ops.clean_measures(empty)).count() == 0
    single = ops.parse_event_time(events_df(spark, [event("a")]))
    assert ops.deduplicate(single).count() == 1


def test_split_late(spark):
    events = ops.parse_event_time(events_df(spark, [event("a"), event("b", 60), event("c", 61)]))
    on_time, late = ops.split_late(events, F.lit(datetime(2024, 3, 1, 10, 1)))
    assert rows_of(on_time, "event_id") == [("b",), ("c",)]
    assert rows_of(late, "event_id") == [("a",)]
