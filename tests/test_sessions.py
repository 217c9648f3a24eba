import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from clickweave import schemas
from clickweave.operators import ordered, sessions
from tests.helpers import START, event, rows_of, silver_df


def _random_walk(seed: int, n: int = 400) -> list[dict]:
    """Events of few sessions over many slices, half of them in one session, with equal times."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        session = 0 if rng.random() < 0.5 else rng.randrange(1, 6)
        rows.append(
            event(
                f"e{i:04d}",
                rng.choice([60 * rng.randrange(400), rng.randrange(30_000)]) + rng.choice([0, 0.3, 0.7]),
                session_id=f"s{session}",
                user_id=f"u{session % 3}",
                event_type=rng.choice(schemas.EVENT_TYPES + ["add_to_cart", "remove_from_cart"]),
                page=f"/{rng.randrange(5)}",
                price=float(rng.randrange(1, 50)),
                quantity=rng.randrange(1, 4),
            )
        )
    return rows


def _by_session(rows: list[dict]) -> dict[str, list[dict]]:
    groups: dict[str, list[dict]] = {}
    for row in sorted(rows, key=lambda r: (r["event_time"], r["event_id"])):
        groups.setdefault(row["session_id"], []).append(row)
    return groups


def _carts(rows: list[dict]) -> list[tuple]:
    out = []
    for session, steps in _by_session(rows).items():
        cart, total = [], 0.0
        for row in steps:
            if row["event_type"] in ("add_to_cart", "purchase"):
                cart.append((row["price"] * row["quantity"], row["quantity"]))
                total += cart[-1][0]
                quantity = row["quantity"]
            elif row["event_type"] == "remove_from_cart":
                worth, pieces = cart.pop() if cart else (0.0, 0)
                total -= worth
                quantity = -pieces
            else:
                continue
            out.append((session, row["event_id"], quantity, len(cart), total))
    return sorted(out)


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("slice_seconds", [60, 3600, 86_400])
def test_running_cart_equals_a_fold(spark, seed, slice_seconds):
    rows = _random_walk(seed)
    cart = sessions.running_cart(silver_df(spark, rows), slice_seconds)
    found = rows_of(cart, "session_id", "event_id", "quantity", "items", "cart_value")
    assert found == _carts(rows)


def test_removing_from_an_empty_cart_changes_nothing(spark):
    kinds = ["remove_from_cart", "add_to_cart", "remove_from_cart", "remove_from_cart", "purchase"]
    rows = [
        event(f"e{i}", i * 4000, event_type=k, price=10.0, quantity=i + 1)
        for i, k in enumerate(kinds)
    ]
    cart = sessions.running_cart(silver_df(spark, rows))
    assert rows_of(cart, "event_id", "quantity", "items", "cart_value") == [
        ("e0", 0, 0, 0.0),
        ("e1", 2, 1, 20.0),
        ("e2", -2, 0, 0.0),
        ("e3", 0, 0, 0.0),
        ("e4", 5, 1, 50.0),
    ]


@pytest.mark.parametrize("seed", range(2))
def test_sliced_operators_equal_plain_loops(spark, seed):
    rows = _random_walk(seed)
    df = ordered.add_slice(sessions.add_instant(silver_df(spark, rows)), seconds=600)
    before = ordered.previous_row(df, ["session_id"], sessions.ORDER, ["event_id"])
    total = ordered.running_sum(
        df, ["session_id"], sessions.ORDER, F.col("quantity"), "so_far"
    )
    want_before, want_total = [], []
    for steps in _by_session(rows).values():
        so_far, last = 0, None
        for row in steps:
            so_far += row["quantity"]
            want_before.append((row["event_id"], last))
            want_total.append((row["event_id"], so_far))
            last = row["event_id"]
    assert rows_of(before, "event_id", "previous.event_id") == sorted(want_before)
    assert rows_of(total, "event_id", "so_far") == sorted(want_total)


def test_transitions_by_hand(spark):
    kinds = ["page_view", "search", "product_view", "page_view", "search"]
    rows = [event(f"e{i}", i * 5000, event_type=k) for i, k in enumerate(kinds)]
    rows += [event("x", 0, session_id="other", event_type="search")]
    silver = silver_df(spark, rows)
    assert rows_of(sessions.transition_matrix(silver)) == [
        ("page_view", "search", 2, 1.0),
        ("product_view", "page_view", 1, 1.0),
        ("search", "product_view", 1, 1.0),
    ]
    illegal = sessions.illegal_transitions(silver)
    assert rows_of(illegal, "session_id", "event_id", "from_type", "to_type") == [
        ("other", "x", None, "search")
    ]


def test_every_rule_pair_is_legal_and_others_are_not(spark):
    pairs = [(a, b) for a in schemas.EVENT_TYPES for b in schemas.EVENT_TYPES]
    rows = []
    for n, (a, b) in enumerate(pairs):
        for i, kind in enumerate(["page_view", a, b]):
            rows.append(event(f"{n}-{i}", i, session_id=f"s{n}", event_type=kind))
    illegal = sessions.illegal_transitions(silver_df(spark, rows)).filter("event_id like '%-2'")
    found = set(rows_of(illegal, "from_type", "to_type"))
    allowed = {(a, b) for a, following in schemas.TRANSITIONS.items() for b in following}
    assert len(allowed) == 29 and found == set(pairs) - allowed


def test_session_rollup_by_hand(spark):
    rows = [
        event("1", 0),
        event("2", 10, event_type="category_view", category="books", page="/category/books"),
        event("3", 20, event_type="search", page="/search"),
        event("4", 30, event_type="category_view", category="toys", page="/category/toys"),
        event("5", 40, event_type="product_view", product_id="p", category="x", page="/product/"),
        event("6", 50, event_type="purchase", product_id="p", category="x", page="/product/"),
        event("7", 60, session_id="s2", user_id="u2"),
    ]
    first, second = sessions.session_rollup(silver_df(spark, rows)).orderBy("started_at").collect()
    assert (first.session_depth, first.searches, first.has_purchased) == (6, 1, True)
    assert (first.pages_visited, first.products_viewed, first.last_category) == (5, 1, "toys")
    assert first.started_at == START and first.ended_at == START + timedelta(seconds=50)
    assert (second.session_depth, second.has_purchased, second.last_category) == (1, False, None)
    items = sessions.session_items(silver_df(spark, rows), "product_id")
    assert rows_of(items, "session_id", "product_id", "times") == [("sess_1", "p", 2)]


@pytest.mark.parametrize("slice_seconds", [1, 3600])
def test_fractions_order_events_within_a_second(spark, slice_seconds):
    rows = [
        event("z", 0.1, event_type="page_view"),
        event("a", 0.9, event_type="logout"),
        event("b", 0.5, event_type="category_view", category="toys"),
        event("y", 0.3, event_type="category_view", category="books"),
    ]
    silver = silver_df(spark, rows)
    steps = sessions.session_steps(silver, slice_seconds)
    assert rows_of(steps, "event_id", "from_type") == [
        ("a", "category_view"),
        ("b", "category_view"),
        ("y", "page_view"),
        ("z", None),
    ]
    flags = sessions.session_flags(silver)
    assert rows_of(flags.filter("is_entry OR is_exit"), "event_id") == [("a",), ("z",)]
    assert sessions.session_rollup(silver).first()["last_category"] == "toys"


def test_session_flags_by_hand(spark):
    rows = [
        event("1", 0),
        event("2", 10),
        event("3", 9000, session_id="late"),
        event("4", 20, session_id="other", user_id="u2"),
        event("5", 9000, session_id="also_late"),
    ]
    flags = sessions.session_flags(silver_df(spark, rows))
    assert rows_of(flags, "event_id", "is_entry", "is_exit", "is_bounce", "session_number") == [
        ("1", True, False, False, 1),
        ("2", False, True, False, 1),
        ("3", True, True, True, 3),
        ("4", True, True, True, 1),
        ("5", True, True, True, 2),
    ]


def test_dimension_violations(spark):
    rows = [
        event("1"),
        event("2", operating_system="Windows"),
        event("3", operating_system="Windows", campaign="newsletter"),
        event("4", event_type="search", page="/"),
    ]
    assert rows_of(sessions.dimension_violations(silver_df(spark, rows))) == [
        ("device_system", "tablet", "Windows", 2),
        ("source_campaign", "referral", "newsletter", 1),
        ("type_page", "search", "/", 1),
    ]


@pytest.mark.parametrize("seed", range(3))
def test_gap_sessions_equal_a_loop(spark, seed):
    rng = random.Random(seed)
    stamps = [(rng.randrange(3), rng.randrange(200) * 300) for _ in range(150)]
    rows = [event(str(i), s, user_id=f"u{u}") for i, (u, s) in enumerate(stamps)]
    want = []
    for u in range(3):
        run: list[int] = []
        for s in sorted(s for v, s in stamps if v == u):
            if run and s - run[-1] > 1800:
                want.append((f"u{u}", run[0], run[-1], len(run)))
                run = []
            run.append(s)
        want.append((f"u{u}", run[0], run[-1], len(run)))
    silver = silver_df(spark, rows)
    for found in (sessions.gap_sessions(silver), sessions.gap_session_windows(silver)):
        got = [
            (r.user_id, (r.session_start - START).seconds, (r.session_end - START).seconds, r.events)
            for r in found.collect()
        ]
        assert sorted(got) == sorted(want)
