"""State ranges: hand-worked goldens, and all forms against a brute force."""

import random

import pytest
from helpers import activity, as_numbers, brute_ranges, day, event, events

from retentide.operators import bitmaps, states
from retentide.operators.activity import active_periods

# Active days, window, last day, and the ranges worked out by hand.
GOLDENS = {
    "all four states": (
        [0, 1, 2, 6, 7], 2, 9,
        [("new", 0, 1), ("retained", 2, 3), ("churned", 4, 5), ("resurrected", 6, 7),
         ("retained", 8, 8), ("churned", 9, None)],
    ),
    "churned spans dormancy": (
        [0, 6], 2, 12,
        [("new", 0, 1), ("churned", 2, 5), ("resurrected", 6, 7), ("churned", 8, None)],
    ),
    "return inside the prior window": (
        [0, 20], 14, 30,
        [("new", 0, 13), ("churned", 14, 19), ("retained", 20, 27), ("resurrected", 28, None)],
    ),
    "one day": ([0], 14, 60, [("new", 0, 13), ("churned", 14, None)]),
}


def from_streaks(spark, days, window, as_of):
    return states.user_states(activity(spark, days), day(as_of), window)


def from_bitmaps(spark, days, window, as_of):
    feed = events(spark, [event(n, user=u) for u, ns in days.items() for n in ns])
    built = bitmaps.build_bitmaps(feed, day(as_of))
    return states.user_states_from_bitmaps(built, window)


def from_counts(spark, days, window, as_of):
    counts = states.window_counts(activity(spark, days), day(as_of), window)
    return states.close_ranges(states.segments(states.islands(states.classify(counts, window))))


FORMS = [from_streaks, from_bitmaps, from_counts]


@pytest.mark.parametrize("form", FORMS)
@pytest.mark.parametrize("name", GOLDENS)
def test_goldens(spark, name, form):
    days, window, as_of, expected = GOLDENS[name]
    got = as_numbers(form(spark, {"u_0001": days}, window, as_of))
    assert got == {("u_0001", *r) for r in expected}


def random_days(seed, users=60, span=90):
    rng = random.Random(seed)
    return {
        f"u_{u:04d}": sorted({n for n in range(span) if rng.random() < rng.choice([0.02, 0.1, 0.5])})
        or [rng.randrange(span)]
        for u in range(users)
    }


@pytest.mark.parametrize("window", [1, 2, 3, 7, 14, 31])
def test_forms_agree_with_brute_force(spark, window):
    days = random_days(window)
    expected = brute_ranges(days, window, 95)
    for form in FORMS:
        assert as_numbers(form(spark, days, window, 95)) == expected, form.__name__


@pytest.mark.parametrize("window", [45, 120])
def test_windows_wider_than_an_integer(spark, window):
    days = random_days(window, users=25, span=500)
    expected = brute_ranges(days, window, 600)
    assert as_numbers(from_streaks(spark, days, window, 600)) == expected
    assert as_numbers(from_counts(spark, days, window, 600)) == expected


def test_activity_after_the_last_day_is_ignored(spark):
    days = random_days(5)
    for as_of in (0, 13, 40):
        assert as_numbers(from_streaks(spark, days, 7, as_of)) == brute_ranges(days, 7, as_of)


def test_repeated_activity_changes_nothing(spark):
    days = {"u_0001": [0, 0, 0, 1, 9, 9, 30], "u_0002": [4, 4]}
    assert as_numbers(from_streaks(spark, days, 3, 40)) == brute_ranges(days, 3, 40)


def test_ranges_are_contiguous_with_one_open(spark):
    ranges = from_streaks(spark, random_days(11), 5, 120).collect()
    by_user = {}
    for r in ranges:
        by_user.setdefault(r.user_id, []).append(r)
    for rows in by_user.values():
        rows.sort(key=lambda r: r.start_date)
        assert [r.end_date is None for r in rows] == [False] * (len(rows) - 1) + [True]
        for a, b in zip(rows, rows[1:]):
            assert (b.start_date - a.end_date).days == 1
            assert a.user_state != b.user_state


def test_history_longer_than_an_integer(spark):
    days = {"u_0001": [0, 70, 71, 100]}
    assert as_numbers(from_bitmaps(spark, days, 14, 130)) == brute_ranges(days, 14, 130)


@pytest.mark.parametrize("window", [32, 63, 90])
def test_wide_windows_from_bitmaps(spark, window):
    days = {"u_0001": [0, 40, 41, 150], "u_0002": [3, 200], "u_0003": [100]}
    source = events(spark, [event(n, user=u) for u, ns in days.items() for n in ns])
    built = bitmaps.build_bitmaps(source, day(260))
    assert as_numbers(states.user_states_from_bitmaps(built, window)) == brute_ranges(days, window, 260)


def test_null_users_are_left_out(spark):
    feed = events(spark, [event(0, user=None), event(0)])
    assert {r.user_id for r in active_periods(feed).collect()} == {"u_0001"}


@pytest.mark.parametrize("key", ["device", "user_id"])
def test_states_do_not_depend_on_the_step_key(spark, key):
    rows = [
        event(n, user=f"u_{u:04d}", platform=p)
        for u, by_platform in enumerate(
            [{"android": [0, 1, 4], "ios": [1]}, {"web": [0, 3], "ios": [3, 4]}, {"ios": [2]}]
        )
        for p, ns in by_platform.items()
        for n in ns
    ]
    feed = events(spark, rows).cache()
    table = bitmaps.build_bitmaps(feed, day(0))
    parts = [table]
    for n in range(1, 6):
        table = spark.createDataFrame(
            bitmaps.carry_forward(table, feed, day(n), key).collect(), table.schema
        )
        parts.append(table)
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    by_bits = as_numbers(states.user_states_from_bitmaps(whole, 2))
    by_days = as_numbers(states.user_states(active_periods(feed), day(5), 2))
    assert by_bits == by_days
