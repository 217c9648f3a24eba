"""Ordered session operators on a stream: steps between event types, the running cart, gap sessions.

Micro-batches bring the events of a session in any order. They wait in the state of a built-in
aggregation, by the second they happened in, until the watermark has passed that second. Those that
are due come out together and are taken in the order of their stated time and id, the same order the
batch operators use. What is kept of a session beyond that is what its next event needs: the type of
the last one, or the cart as a stack.

Each access of a processor to its state is a message between processes. So sessions (users) are dealt
by hash to GROUPS groups, whose state is read once and written once per batch that has rows of them.

Gap sessions are put together from buckets, not events, so a user of very many events has a few rows
in the task that orders them. These rows come as frames, and only the first and the last session of a
user in a batch are compared with the state, row by row.

Events behind the watermark are dropped by the operator; `metrics.late_rows` lists them. A session's
events that become due together are sorted in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from clickweave.operators import sessions

#: Sessions share a state entry with those of the same hash, of so many values. More of them make a
#: batch that touches few sessions write less, and one that touches most of them send more messages.
GROUPS = 1 << 12
#: Levels of a cart kept with its totals; deeper ones have an entry each.
TOP_LEVELS = 16

_EVENT = ["at", "event_id", "event_type", "amount", "quantity"]


def _group(name: str) -> Column:
    return F.pmod(F.xxhash64(name), F.lit(GROUPS)).alias("group")


def _plain(fields: list) -> tuple:
    """Fields as read from state with tuples for their rows, as a Row inside cannot be stored again."""
    return tuple([tuple(e) for e in f] if isinstance(f, list) else f for f in fields)


class _InOrder(StatefulProcessor):
    """Gives the due events of each session of a group to `steps` in order.

    KEPT are the fields kept of a session; `steps` returns the new ones.
    """

    KEPT = ""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getValueState(
            "kept", f"sessions array<struct<session_id: string, {self.KEPT}>>"
        )

    def steps(
        self, session_id: str, kept: tuple | None, events: list[tuple], out: list[Row]
    ) -> tuple:
        raise NotImplementedError

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        due: dict[str, list[tuple]] = {}
        for r in rows:
            event = tuple(r[name] for name in _EVENT)
            due.setdefault(r["session_id"], []).extend([event] * r["copies"])
        if not due:
            return
        found = self.kept.get()
        kept = {session_id: _plain(rest) for session_id, *rest in found[0]} if found else {}
        out: list[Row] = []
        for session_id, events in due.items():
            events.sort(key=lambda e: (e[0], e[1]))
            kept[session_id] = self.steps(session_id, kept.get(session_id), events, out)
        self.kept.update(([(session_id, *rest) for session_id, rest in kept.items()],))
        yield from out

    def close(self) -> None:
        pass


class _Steps(_InOrder):
    SCHEMA = "session_id string, at bigint, event_id string, from_type string, to_type string"
    KEPT = "event_type: string"

    def steps(
        self, session_id: str, kept: tuple | None, events: list[tuple], out: list[Row]
    ) -> tuple:
        from_type = kept[0] if kept else None
        for at, event_id, to_type, *_ in events:
            out.append(
                Row(
                    session_id=session_id,
                    at=at,
                    event_id=event_id,
                    from_type=from_type,
                    to_type=to_type,
                )
            )
            from_type = to_type
        return (from_type,)


class _Cart(_InOrder):
    SCHEMA = (
        "session_id string, at bigint, event_id string, event_type string, amount double, "
        "quantity int, items bigint, cart_value double"
    )
    KEPT = (
        "items: bigint, cart_value: double, top: array<struct<amount: double, quantity: int>>"
    )

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.deep = handle.getMapState(
            "deep", "session_id string, level bigint", "amount double, quantity int"
        )

    def _pop(self, session_id: str, level: int) -> tuple:
        entry = self.deep.getValue((session_id, level))
        self.deep.removeKey((session_id, level))
        return entry

    def steps(
        self, session_id: str, kept: tuple | None, events: list[tuple], out: list[Row]
    ) -> tuple:
        items, value, top = kept or (0, 0.0, [])
        top = [tuple(entry) for entry in top]  # the uppermost levels, the last one on top
        for at, event_id, event_type, amount, quantity in events:
            if event_type != "remove_from_cart":
                items += 1
                top.append((amount, quantity))
            elif items:
                entry = top.pop() if top else self._pop(session_id, items)
                items -= 1
                amount, quantity = (None if part is None else -part for part in entry)
            else:
                amount, quantity = 0.0, 0
            value += amount or 0.0
            out.append(
                Row(
                    session_id=session_id,
                    at=at,
                    event_id=event_id,
                    event_type=event_type,
                    amount=amount,
                    quantity=quantity,
                    items=items,
                    cart_value=value,
                )
            )
        lowest = items - len(top) + 1
        for i in range(len(top) - TOP_LEVELS):
            self.deep.updateValue((session_id, lowest + i), top[i])
        return items, value, top[-TOP_LEVELS:]


def _run(events: DataFrame, processor: _Steps | _Cart) -> DataFrame:
    worth = F.col("price") * F.col("quantity")
    rows = sessions.add_instant(events).select(
        "session_id",
        "event_timestamp",
        F.unix_micros(sessions.INSTANT).alias("at"),
        "event_id",
        "event_type",
        worth.alias("amount"),
        "quantity",
    )
    second = F.window("event_timestamp", "1 second").alias("second")
    due = (
        rows.groupBy(second, "session_id", *_EVENT)
        .agg(F.count(F.lit(1)).alias("copies"))
        .select(_group("session_id"), "session_id", "second", *_EVENT, "copies")
    )
    out = due.groupBy("group").transformWithState(processor, processor.SCHEMA, "Append", "None")
    at = F.date_trunc("second", F.timestamp_micros("at"))
    rest = [c for c in out.columns if c not in ("group", "session_id", "at")]
    return out.select("session_id", at.alias("event_timestamp"), *rest)


def session_steps(events: DataFrame) -> DataFrame:
    """`sessions.session_steps` of a stream with a watermark on event_timestamp, in append mode."""
    return _run(events, _Steps())


def running_cart(events: DataFrame) -> DataFrame:
    """`sessions.running_cart` of a stream with a watermark on event_timestamp, in append mode."""
    kinds = ["add_to_cart", "purchase", "remove_from_cart"]
    return _run(events.filter(F.col("event_type").isin(kinds)), _Cart())


def _watermark(timerValues: Any) -> int:
    return timerValues.getCurrentWatermarkInMs() if timerValues else -1


class _Gaps(StatefulProcessor):
    """Joins the buckets of each user of a group, which come in the order of time, to sessions.

    What the watermark has passed when a batch ends comes out with it. Only the rest is stored and
    gets timers.
    """

    SCHEMA = "user_id {kind}, first_at bigint, last_at bigint, events bigint"

    def __init__(self, gap_micros: int, kind: str):
        self.gap = gap_micros
        self.kind = kind

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState(
            "open",
            f"users array<struct<user_id: {self.kind}, first_at: bigint, last_at: bigint, "
            "events: bigint, closes: bigint>>",
        )

    def _closes(self, last: int) -> int:
        """When the bucket that a next event could be in is over too, in milliseconds."""
        return ((last + self.gap) // self.gap + 1) * self.gap // 1000

    def _row(self, user: Any, first: int, last: int, events: int, closes: int) -> Row:
        return Row(user_id=user, first_at=first, last_at=last, events=events)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        buckets = sorted((r.first_at, r.last_at, r.events, i, r.user_id) for i, r in enumerate(rows))
        if not buckets:
            return
        found = self.open.get()
        kept = {user: tuple(rest) for user, *rest in found[0]} if found else {}
        known = {closes for *_, closes in kept.values()}
        for first, last, events, _, user in buckets:
            session = kept.get(user)
            if session is not None:
                if first - session[1] > self.gap:
                    yield self._row(user, *session)
                else:
                    first, events = session[0], session[2] + events
            kept[user] = (first, last, events, self._closes(last))
        now = _watermark(timerValues)
        for user in [user for user, (*_, closes) in kept.items() if closes <= now]:
            yield self._row(user, *kept.pop(user))
        if kept:
            self.open.update(([(user, *rest) for user, rest in kept.items()],))
        elif found:
            self.open.clear()
        # A timer whose sessions have all been extended or closed finds none to close.
        for closes in {closes for *_, closes in kept.values()} - known:
            self.handle.registerTimer(closes)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        # The first timer of a batch closes what the others are for, too.
        now = max(expiredTimerInfo.getExpiryTimeInMs(), _watermark(timerValues))
        found = self.open.get()
        if not found:
            return
        later = [entry for entry in found[0] if entry[4] > now]
        if len(later) == len(found[0]):
            return
        if later:
            self.open.update(([tuple(entry) for entry in later],))
        else:
            self.open.clear()
        for entry in found[0]:
            if entry[4] <= now:
                yield self._row(*entry)

    def close(self) -> None:
        pass


_SPAN = ["user_id", "first_at", "last_at", "events"]


def _joined(spans: pd.DataFrame, gap_micros: int) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Sessions that the spans of users make among themselves.

    First those between two others of their user, which no other span can reach, then each user's
    first and last.
    """
    user = pd.factorize(spans["user_id"])[0]  # -1 for null, which is one user
    order = np.lexsort((spans["first_at"].to_numpy(), user))
    user, spans = user[order], spans.iloc[order]
    first, last, events = (spans[name].to_numpy() for name in _SPAN[1:])
    other = np.append(True, user[1:] != user[:-1])
    starts = np.flatnonzero(other | np.append(True, first[1:] - last[:-1] > gap_micros))
    found = pd.DataFrame(
        {
            "user_id": spans["user_id"].to_numpy()[starts],
            "first_at": first[starts],
            "last_at": last[np.append(starts[1:], len(last)) - 1],
            "events": np.add.reduceat(events, starts),
        }
    )
    ends = other[starts] | np.append(other[starts][1:], True)
    return found[~ends], found[ends]


class _GapFrames(_Gaps):
    """`_Gaps` for frames of buckets: a Row costs many times what a row of a frame does.

    Users are text, as numbers with nulls among them would become doubles in a frame.
    """

    def __init__(self, gap_micros: int):
        super().__init__(gap_micros, "string")

    def handleInputRows(
        self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any
    ) -> Iterator[pd.DataFrame]:
        between, ends = _joined(pd.concat(rows), self.gap)
        closed = super().handleInputRows(key, ends.itertuples(index=False), timerValues)
        yield pd.concat([between, pd.DataFrame(closed, columns=_SPAN)])

    def handleExpiredTimer(
        self, key: Any, timerValues: Any, expiredTimerInfo: Any
    ) -> Iterator[pd.DataFrame]:
        closed = list(super().handleExpiredTimer(key, timerValues, expiredTimerInfo))
        if closed:
            yield pd.DataFrame(closed, columns=_SPAN)


def gap_sessions(
    events: DataFrame,
    user: str = "user_id",
    ts: str = "event_timestamp",
    gap_seconds: int = 1800,
) -> DataFrame:
    """`sessions.gap_sessions` of a stream with a watermark on `ts`, in append mode.

    Two chained steps: buckets of the gap's length per user, which combine before the shuffle and
    spread a busy user over its buckets; then sessions over one row per user and bucket. A session
    comes out when the watermark has passed every bucket that could continue it.
    """
    bucket = F.window(ts, f"{gap_seconds} seconds").alias("bucket")
    buckets = (
        events.groupBy(bucket, F.col(user).alias("user_id"))
        .agg(F.min(ts).alias("first"), F.max(ts).alias("last"), F.count(F.lit(1)).alias("events"))
        .select(
            _group("user_id"),
            F.col("user_id").cast("string").alias("user_id"),
            F.window_time("bucket").alias("bucket_time"),
            F.unix_micros("first").alias("first_at"),
            F.unix_micros("last").alias("last_at"),
            "events",
        )
    )
    kind = events.schema[user].dataType.simpleString()
    processor = _GapFrames(gap_seconds * 1_000_000)
    out = buckets.groupBy("group").transformWithStateInPandas(
        processor, processor.SCHEMA.format(kind="string"), "Append", "EventTime"
    )
    return out.select(
        F.col("user_id").cast(kind).alias(user),
        F.timestamp_micros("first_at").alias("session_start"),
        F.timestamp_micros("last_at").alias("session_end"),
        "events",
    )
