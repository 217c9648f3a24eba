"""Session-level operators over cleaned events.

A session, user or item may hold a large share of all rows. Everything here first shrinks rows
with aggregations that combine before the shuffle, or works on time slices of a group (see
`ordered`); no group is gathered whole in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickweave import schemas
from clickweave.functions.measures import count_of
from clickweave.functions.time import event_timestamp, time_slice
from clickweave.operators import ordered
from clickweave.session import materialize

INSTANT = "_instant"
ORDER = [INSTANT, "event_id"]
PLACE = ["event_timestamp", "event_id"]
SESSION_START = ""
_SESSION_ITEMS = {"user": "user_id", "page": "page", "product": "product_id"}


def add_instant(events: DataFrame) -> DataFrame:
    """Add the stated time with its fraction: it orders events that `event_timestamp` cuts alike."""
    exact = event_timestamp(F.col("event_time"), keep_fraction=True)
    return events.withColumn(INSTANT, F.coalesce(exact, F.col("event_timestamp")))


def session_parts(events: DataFrame) -> DataFrame:
    """What one set of events adds to its sessions: sums in a row of kind `event`, a row for each
    distinct user, page and product, and the place of the last category view.

    Parts of several sets add up to the rollup of all their events. Only category views are compared
    as texts and so sorted; all other events are added up by hash.
    """
    kind = F.col("event_type")
    entries = [F.struct(F.lit("event").alias("kind"), F.lit(None).cast("string").alias("id"))]
    entries += [
        F.struct(F.lit(name).alias("kind"), F.col(column).alias("id"))
        for name, column in _SESSION_ITEMS.items()
    ]
    sums = (
        events.select(
            "session_id",
            "event_type",
            "event_timestamp",
            F.explode(F.array(*entries)).alias("entry"),
        )
        .filter((F.col("entry.kind") == "event") | F.col("entry.id").isNotNull())
        .groupBy("session_id", F.col("entry.kind").alias("kind"), F.col("entry.id").alias("id"))
        .agg(
            F.min("event_timestamp").alias("first_at"),
            F.max("event_timestamp").alias("last_at"),
            F.count(F.lit(1)).alias("events"),
            count_of(kind, "search").alias("searches"),
            count_of(kind, "purchase").alias("purchases"),
        )
        .withColumns(
            {"place": F.lit(None).cast("bigint"), "event_id": F.lit(None).cast("string")}
        )
    )
    views = add_instant(events.filter(kind == "category_view"))
    last = F.struct(F.unix_micros(INSTANT).alias("place"), "event_id", "category")
    none, zero = F.lit(None).cast("timestamp"), F.lit(0).cast("bigint")
    categories = (
        views.groupBy("session_id")
        .agg(F.max(last).alias("last"))
        .select(
            "session_id",
            F.lit("category").alias("kind"),
            F.col("last.category").alias("id"),
            none.alias("first_at"),
            none.alias("last_at"),
            *[zero.alias(name) for name in ("events", "searches", "purchases")],
            "last.place",
            "last.event_id",
        )
    )
    return sums.unionByName(categories)


def rollup_of(parts: DataFrame) -> DataFrame:
    """The session rollup of the parts of any number of event sets that share no event."""
    once = parts.groupBy("session_id", "kind", "id", "place", "event_id").agg(
        F.min("first_at").alias("first_at"),
        F.max("last_at").alias("last_at"),
        *[F.sum(name).alias(name) for name in ("events", "searches", "purchases")],
    )

    def of(kind: str, value: str) -> Column:
        return F.when(F.col("kind") == kind, F.col(value))

    return once.groupBy("session_id").agg(
        F.min(of("user", "id")).alias("user_id"),
        F.min(of("event", "first_at")).alias("started_at"),
        F.max(of("event", "last_at")).alias("ended_at"),
        F.sum(of("event", "events")).alias("session_depth"),
        F.sum(of("event", "searches")).alias("searches"),
        (F.sum(of("event", "purchases")) > 0).alias("has_purchased"),
        F.count_if(F.col("kind") == "page").alias("pages_visited"),
        F.count_if(F.col("kind") == "product").alias("products_viewed"),
        F.max_by(
            of("category", "id"), F.when(F.col("kind") == "category", F.struct("place", "event_id"))
        ).alias("last_category"),
    )


def session_rollup(events: DataFrame) -> DataFrame:
    """One row per session: span, depth, searches, purchase, distinct pages and products.

    The pages and products themselves are in `session_items`, one row each. For events that come
    batch by batch, add up `session_parts` with `rollup_of`.
    """
    kind = F.col("event_type")
    position = F.struct(*ORDER)
    return add_instant(events).groupBy("session_id").agg(
        F.min("user_id").alias("user_id"),
        F.min("event_timestamp").alias("started_at"),
        F.max("event_timestamp").alias("ended_at"),
        F.count(F.lit(1)).alias("session_depth"),
        count_of(kind, "search").alias("searches"),
        F.coalesce(F.bool_or(kind == "purchase"), F.lit(False)).alias("has_purchased"),
        F.countDistinct("page").alias("pages_visited"),
        F.countDistinct("product_id").alias("products_viewed"),
        F.max_by(
            F.when(kind == "category_view", F.col("category")),
            F.when(kind == "category_view", position),
        ).alias("last_category"),
    )


def session_items(events: DataFrame, item: str) -> DataFrame:
    """Distinct values of `item` (page, product_id) per session, with first sight and count."""
    return (
        events.filter(F.col(item).isNotNull())
        .groupBy("session_id", item)
        .agg(
            F.min("event_timestamp").alias("first_seen"),
            F.count(F.lit(1)).alias("times"),
        )
    )


def session_steps(
    events: DataFrame, slice_seconds: int = ordered.SLICE_SECONDS
) -> DataFrame:
    """Each event with the type of the event before it in its session (NULL for the first)."""
    rows = ordered.add_slice(
        add_instant(events).select("session_id", INSTANT, *PLACE, "event_type"),
        seconds=slice_seconds,
    )
    stepped = ordered.previous_row(rows, ["session_id"], ORDER, ["event_type"])
    return stepped.select(
        "session_id",
        *PLACE,
        F.col("previous.event_type").alias("from_type"),
        F.col("event_type").alias("to_type"),
    )


def transition_matrix(
    events: DataFrame, slice_seconds: int = ordered.SLICE_SECONDS
) -> DataFrame:
    """How often each type follows each other type, and with what probability."""
    return matrix_of(session_steps(events, slice_seconds))


def matrix_of(steps: DataFrame) -> DataFrame:
    """The transition matrix of steps, those of a batch or those a stream has written."""
    counts = (
        steps.filter(F.col("from_type").isNotNull())
        .groupBy("from_type", "to_type")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    whole = F.sum("n").over(Window.partitionBy("from_type"))
    return counts.withColumn("probability", F.col("n") / whole)


def illegal_transitions(
    events: DataFrame, slice_seconds: int = ordered.SLICE_SECONDS
) -> DataFrame:
    """Steps the rule table does not allow, and sessions not starting with a page view."""
    return illegal_of(session_steps(events, slice_seconds))


def illegal_of(steps: DataFrame) -> DataFrame:
    """The illegal ones of steps; on a stream as they come, since the rules are a small table."""
    allowed = [(a, b) for a, following in schemas.TRANSITIONS.items() for b in following]
    allowed.append((SESSION_START, "page_view"))
    rules = steps.sparkSession.createDataFrame(allowed, "after string, to_type string")
    steps = steps.withColumn(
        "after", F.coalesce("from_type", F.lit(SESSION_START))
    )
    return steps.join(F.broadcast(rules), ["after", "to_type"], "left_anti").select(
        "session_id", *PLACE, "from_type", "to_type"
    )


CONFORMANCE_RULES = {
    "device_system": ("device", "operating_system", schemas.DEVICE_SYSTEMS),
    "source_campaign": ("traffic_source", "campaign", schemas.SOURCE_CAMPAIGNS),
    "type_page": ("event_type", "page", schemas.TYPE_PAGES),
}


def dimension_violations(events: DataFrame) -> DataFrame:
    """Value pairs no rule allows, with the number of events that carry them.

    Pairs of all three rules are counted in one pass, and only the counted pairs meet the rules.
    """
    pairs = F.array(
        *[
            F.struct(
                F.lit(rule).alias("rule"),
                F.col(left).alias("left_value"),
                F.col(right).alias("right_value"),
            )
            for rule, (left, right, _) in CONFORMANCE_RULES.items()
        ]
    )
    counted = (
        events.select(F.inline(pairs))
        .groupBy("rule", "left_value", "right_value")
        .agg(F.count(F.lit(1)).alias("events"))
    )
    allowed = [
        (rule, a, b)
        for rule, (_, _, table) in CONFORMANCE_RULES.items()
        for a, values in table.items()
        for b in values
    ]
    rules = events.sparkSession.createDataFrame(
        allowed, "rule string, left_value string, right_value string"
    )
    return counted.join(F.broadcast(rules), ["rule", "left_value", "right_value"], "left_anti")


def _session_numbers(sessions: DataFrame) -> DataFrame:
    """Number each user's sessions by start: those of earlier slices plus the rank in the slice."""
    within = ["user_id", ordered.SLICE]
    started = ordered.add_slice(sessions, "started_at")
    rank = F.row_number().over(Window.partitionBy(*within).orderBy("started_at", "session_id"))
    earlier = (
        Window.partitionBy("user_id")
        .orderBy(ordered.SLICE)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    counts = (
        started.groupBy(*within)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(*within, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    )
    return (
        started.withColumn("rank", rank)
        .join(counts, within)
        .withColumn("session_number", F.col("base") + F.col("rank"))
        .drop(ordered.SLICE, "base", "rank")
    )


def session_flags(events: DataFrame) -> DataFrame:
    """Mark each event as its session's entry or exit, with bounce flag and session number.

    Sessions are summarised once, by a combining aggregation into a scratch table that is written
    while this plan is built, and joined back; if one session holds many rows, adaptive execution
    splits its side of the join.
    """
    # Events without a readable time have no place in the order: never first, last or numbered.
    position = F.when(F.col(INSTANT).isNotNull(), F.struct(*ORDER))
    summary = (
        add_instant(events)
        .groupBy("session_id")
        .agg(
            F.min("user_id").alias("user_id"),
            F.min(position).alias("first"),
            F.max(position).alias("last"),
            F.count(F.lit(1)).alias("n"),
        )
        .withColumn("started_at", F.col(f"first.{INSTANT}"))
    )
    sessions = materialize(summary, "sessions")
    numbers = _session_numbers(sessions.filter(F.col("started_at").isNotNull()))
    numbered = sessions.drop("user_id", "started_at").join(
        numbers.select("session_id", "session_number"), "session_id", "left"
    )
    return events.join(numbered, "session_id").select(
        *[F.col(c) for c in events.columns if c != "is_bounce"],
        F.coalesce(F.col("event_id") == F.col("first.event_id"), F.lit(False)).alias("is_entry"),
        F.coalesce(F.col("event_id") == F.col("last.event_id"), F.lit(False)).alias("is_exit"),
        (F.col("n") == 1).alias("is_bounce"),
        "session_number",
    )


def gap_sessions(
    events: DataFrame,
    user: str = "user_id",
    ts: str = "event_timestamp",
    gap_seconds: int = 1800,
) -> DataFrame:
    """Batch: sessions of a user's events, split where more than `gap_seconds` pass.

    Two events in the same bucket of that length are always in the same session. So events are
    first combined per (user, bucket), and only those few rows are ordered per user.
    """
    buckets = (
        events.filter(F.col(ts).isNotNull())
        .groupBy(user, time_slice(F.col(ts), gap_seconds).alias("bucket"))
        .agg(
            F.min(ts).alias("first_at"),
            F.max(ts).alias("last_at"),
            F.count(F.lit(1)).alias("n"),
        )
    )
    in_order = Window.partitionBy(user).orderBy("bucket")
    idle = F.unix_micros("first_at") - F.unix_micros(F.lag("last_at").over(in_order))
    starts = F.coalesce(idle > gap_seconds * 1_000_000, F.lit(True)).cast("int")
    numbered = buckets.withColumn("starts", starts).withColumn(
        "session_number", F.sum("starts").over(in_order)
    )
    return numbered.groupBy(user, "session_number").agg(
        F.min("first_at").alias("session_start"),
        F.max("last_at").alias("session_end"),
        F.sum("n").alias("events"),
    )


def gap_session_windows(
    events: DataFrame,
    user: str = "user_id",
    ts: str = "event_timestamp",
    gap: str = "30 minutes",
) -> DataFrame:
    """Stream, append mode: the same sessions from Spark's session windows."""
    return (
        events.groupBy(F.session_window(ts, gap).alias("session"), user)
        .agg(
            F.min(ts).alias("session_start"),
            F.max(ts).alias("session_end"),
            F.count(F.lit(1)).alias("events"),
        )
        .drop("session")
    )


def running_cart(events: DataFrame, slice_seconds: int = ordered.SLICE_SECONDS) -> DataFrame:
    """The cart after every cart event, with a removal taking back the item added last.

    Adding and purchasing push price x quantity; a removal pops, and does nothing on an empty
    cart. Along a session the events at one stack level alternate push, pop, push, ..., so the
    item a pop takes back is simply the row before it at its level.
    """
    pushes = F.col("event_type").isin("add_to_cart", "purchase")
    rows = ordered.add_slice(
        add_instant(events.filter(pushes | (F.col("event_type") == "remove_from_cart"))).select(
            "session_id",
            INSTANT,
            *PLACE,
            "event_type",
            F.when(pushes, 1).otherwise(-1).alias("step"),
            F.when(pushes, F.col("price") * F.col("quantity")).alias("amount"),
            "quantity",
        ),
        seconds=slice_seconds,
    )
    deep = materialize(
        ordered.stack_depth(rows, ["session_id"], ORDER, "step").withColumn(
            "level", F.greatest("depth", "depth_before")
        ),
        "cart-depth",
    )
    paired = ordered.previous_row(deep, ["session_id", "level"], ORDER, ["amount", "quantity"])
    pushed, popped = F.col("step") > 0, (F.col("step") < 0) & (F.col("depth_before") > 0)

    def change(name: str, idle: Column) -> Column:
        taken_back = F.when(popped, idle - F.col(f"previous.{name}")).otherwise(idle)
        return F.when(pushed, F.col(name)).otherwise(taken_back)

    changes = materialize(
        paired.select(
            "session_id",
            INSTANT,
            *PLACE,
            "event_type",
            ordered.SLICE,
            change("amount", F.lit(0.0)).alias("amount"),
            change("quantity", F.lit(0)).alias("quantity"),
            F.col("depth").alias("items"),
        ),
        "cart-changes",
    )
    return ordered.running_sum(
        changes, ["session_id"], ORDER, F.col("amount"), "cart_value"
    ).drop(ordered.SLICE, INSTANT)

