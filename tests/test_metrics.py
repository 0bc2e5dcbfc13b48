"""Growth accounting, cohorts, engagement, sessions, balances and cleaning."""

from datetime import datetime

import pytest
from helpers import activity, day, event, events
from pyspark.sql import functions as F

from retentide.functions.calendar import parse_day
from retentide.operators import cleaning, engagement, growth
from retentide.operators import activity as act
from retentide.sources.sample_tables import loyalty_events, order_events

SF_DIR = "/root/testdata/sf0.001"


def test_growth_by_day(spark):
    got = growth.growth_accounting(
        activity(spark, {"a": [0, 1, 3], "b": [1], "c": [4]}), "day", day(4)
    )
    rows = {
        (r.period_start - day(0)).days: (
            r.active_users, r.new_users, r.retained_users, r.resurrected_users, r.churned_users
        )
        for r in got.collect()
    }
    assert rows == {
        0: (1, 1, 0, 0, 0),
        1: (2, 1, 1, 0, 0),
        2: (0, 0, 0, 0, 2),
        3: (1, 0, 0, 1, 0),
        4: (1, 1, 0, 0, 1),
    }


@pytest.mark.parametrize("period", ["day", "week", "month"])
@pytest.mark.parametrize("source", [loyalty_events, order_events])
def test_active_users_follow_from_the_changes(spark, source, period):
    feed = source(spark, SF_DIR)
    last = feed.agg(F.max("event_date")).first()[0]
    rows = growth.growth_accounting(act.active_periods(feed, period), period, last).collect()
    # Day-grain activity gives the same periods.
    assert set(growth.growth_accounting(act.active_periods(feed), period, last).collect()) == set(rows)
    rows.sort(key=lambda r: r.period_start)
    for before, r in zip(rows, rows[1:]):
        if period == "day" and (r.period_start - before.period_start).days > 1:
            assert before.active_users == 0
        assert r.active_users == (
            before.active_users + r.new_users + r.resurrected_users - r.churned_users
        )
        assert r.active_users == r.new_users + r.retained_users + r.resurrected_users


def test_cohorts_not_reached_yet_are_null(spark):
    got = growth.cohort_retention(activity(spark, {"a": [0, 1, 7], "b": [0], "c": [5, 6]}), day(8))
    rows = {((r.cohort_date - day(0)).days, r.day_offset): r for r in got.collect()}
    assert len(rows) == 8
    assert (rows[0, 1].retained_users, rows[0, 1].retention_pct) == (1, 50.0)
    assert rows[0, 7].retention_pct == 50.0
    assert rows[0, 14].retained_users is None and rows[0, 14].retention_pct is None
    assert rows[5, 1].retention_pct == 100.0
    assert rows[5, 7].retained_users is None


def test_engagement_without_earners_is_null(spark):
    feed = events(
        spark,
        [event(0, kind="miles_redeemed"), event(0), event(1, kind="miles_earned"),
         event(1, kind="miles_redeemed", user="u_0002")],
    )
    daily = act.user_daily_activity(feed)
    rows = {(r.period_start - day(0)).days: r for r in engagement.engagement_depth(daily).collect()}
    assert rows[0].redemption_rate is None and rows[0].events_per_user == 2.0
    assert rows[1].redemption_rate == 1.0 and rows[1].miles_per_user == 5.0
    weekly = engagement.engagement_depth(daily, "week").collect()
    assert len(weekly) == 1 and weekly[0].active_users == 2 and weekly[0].total_events == 4


def test_sessions_split_by_more_than_the_gap(spark):
    at = [(0, 23, 50), (1, 0, 10), (1, 0, 40), (1, 1, 11), (1, 5, 0)]
    feed = events(spark, [event(n, hour=h, minute=m) for n, h, m in at])
    row = engagement.session_frequency(feed, "week").collect()[0]
    assert (row.active_days, row.sessions) == (2, 3)


def test_sessions_equal_event_by_event_count(spark):
    rows = [
        event((u * 37 + i * i) % 9, user=f"u_{u:04d}", hour=(i * 7 + u) % 24, minute=(i * 13) % 60)
        for u in range(8) for i in range(60)
    ]
    expected = {}
    for u in {r["user_id"] for r in rows}:
        times = sorted(r["event_time"] for r in rows if r["user_id"] == u)
        expected[u] = sum(
            1 for i, t in enumerate(times) if i == 0 or (t - times[i - 1]).total_seconds() > 2700
        )
    got = engagement.session_frequency(events(spark, rows), "month", gap_seconds=2700)
    totals = {r.user_id: r.n for r in got.groupBy("user_id").agg(F.sum("sessions").alias("n")).collect()}
    assert totals == expected


def test_balance_runs_over_days(spark):
    feed = events(
        spark,
        [event(0, kind="miles_earned", miles_amount=30.0), event(2, kind="miles_redeemed"),
         event(3), event(3, kind="miles_earned", miles_amount=5.0)],
    )
    got = act.user_miles_balance(act.user_daily_activity(feed)).orderBy("event_date").collect()
    assert [r.miles_balance for r in got] == [30.0, 20.0, 25.0]


def test_dedup_keeps_the_least_row_once(spark):
    rows = [event(0, country=c) for c in ("SG", "MY", "TH")] + [event(0, country="MY")] * 50
    rows += [event(0, kind="share"), event(0, user="u_0002")]
    got = cleaning.dedup(events(spark, rows)).collect()
    assert len(got) == 3
    assert [r.country for r in got if r.user_id == "u_0001" and r.event_type == "like"] == ["MY"]


def test_clean_fills_only_other_events(spark):
    feed = events(
        spark,
        [event(0, kind="miles_earned", miles_amount=None), event(0),
         event(0, kind="reward_search", transaction_category="brand")],
    )
    rows = {r.event_type: r for r in cleaning.clean(feed).collect()}
    assert rows["miles_earned"].miles_amount is None
    assert rows["miles_earned"].miles_category == "dining" and rows["miles_earned"].is_transactional
    assert rows["like"].miles_amount == 0.0 and not rows["like"].is_transactional
    assert rows["reward_search"].search_brand == "brand"
    assert rows["reward_search"].miles_category is None


def test_job_argument():
    assert parse_day("20250206") == datetime(2025, 2, 6).date()
