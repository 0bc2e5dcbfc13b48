"""The step of a day from the snapshot of the day before, the ledger of loaded days, and rolling users."""

import random
from datetime import timedelta

import pytest
from helpers import activity as activity_rows
from helpers import as_numbers, brute_ranges, day, event, events
from pyspark.sql import functions as F
from test_jobs import log, names, other_names, snapshot, table_rows, write_raw  # noqa: F401

from retentide.operators import activity, rolling
from retentide.operators import snapshot as snaps
from retentide.plans import jobs
from retentide.schemas import USER_SNAPSHOT
from retentide.sources import tables

HISTORY = ("before", "earn_before", "redeem_before", "closed_since")  # of the step only


def random_log(seed, days, users=25):
    draw = random.Random(seed)
    kinds = ("miles_earned", "miles_redeemed", "like")
    rows = []
    for u in range(users):
        rate = draw.choice([0.05, 0.2, 0.6])
        rows += [event(n, user=f"u_{u:04d}", kind=draw.choice(kinds)) for n in range(days) if draw.random() < rate]
    return rows


@pytest.mark.parametrize("window", [1, 2, 5])
def test_stepping_equals_the_whole_history(spark, window):
    daily = activity.user_daily_activity(events(spark, random_log(window, 20))).cache()
    now = spark.createDataFrame([], USER_SNAPSHOT)
    columns = [c for c in USER_SNAPSHOT.fieldNames() if c not in HISTORY]
    ranges: dict = {}
    for n in range(20):
        now = spark.createDataFrame(snaps.advance(now, daily.where(F.col("event_date") == F.lit(day(n))), day(n), window).collect(), USER_SNAPSHOT)
        if n % 4 == 3:
            whole = snaps.user_snapshot(daily, day(n), window)
            assert sorted(map(tuple, now.select(*columns).collect()), key=str) == sorted(map(tuple, whole.select(*columns).collect()), key=str)
        for r in now.where("closed_since IS NOT NULL").select("user_id", F.date_from_unix_date("closed_since").alias("start")).collect():
            ranges[r.user_id, r.start] = (ranges[r.user_id, r.start][0], day(n - 1))
        for r in snaps.opened_ranges(now, day(n)).collect():
            ranges[r.user_id, r.start_date] = (r.user_state, None)
    days: dict = {}
    for r in daily.select("user_id", "event_date").collect():
        days.setdefault(r.user_id, set()).add((r.event_date - day(0)).days)
    number = lambda d: d and (d - day(0)).days
    assert {(u, s, number(start), number(end)) for (u, start), (s, end) in ranges.items()} == brute_ranges(days, window, 19)


def test_daily_steps_give_the_tables_of_a_backfill(spark, tmp_path, names):  # noqa: F811
    """A month's end, a day without events, and all the tables; the days before the step aren't read."""
    start = 20  # 2025-02-26
    rows = [event(start + (r["event_time"].date() - day(0)).days, user=r["user_id"], kind=r["event_type"]) for r in random_log(9, 5)]
    rows = [r for r in rows if r["event_time"].date() != day(start + 3)]
    raw = write_raw(spark, tmp_path, rows)
    jobs.backfill(spark, raw, day(start), day(start + 1), names)
    held = tables.day_partition(spark, names.activity, day(start)).collect()
    tables.drop_day(spark, names.activity, day(start))
    for n in (2, 3, 4):
        jobs.run_day(spark, raw, day(start + n), names)
        assert tables.partition_days(spark, names.snapshot) == [day(start + n)]
    tables.replace_day(spark.createDataFrame(held, spark.table(names.activity).schema), names.activity, day(start))
    other = other_names()
    jobs.backfill(spark, raw, day(start), day(start + 4), other)
    assert snapshot(spark, names) == snapshot(spark, other)
    assert table_rows(spark, names.rolling) == table_rows(spark, other.rolling)
    assert table_rows(spark, names.ledger) == table_rows(spark, other.ledger)


def test_a_broken_step_ends_in_a_rebuild(spark, tmp_path, names):  # noqa: F811
    raw = write_raw(spark, tmp_path, log(3))
    jobs.backfill(spark, raw, day(0), day(1), names, metrics=False)
    kept = jobs._step_states
    try:
        jobs._step_states = lambda *a: (_ for _ in ()).throw(RuntimeError("lost"))
        with pytest.raises(RuntimeError, match="lost"):
            jobs.run_day(spark, raw, day(2), names, metrics=False)
    finally:
        jobs._step_states = kept
    assert not jobs.step_gold(spark, day(2), names, metrics=False)
    jobs.run_day(spark, raw, day(2), names, metrics=False)
    days: dict = {}
    for r in log(2):
        days.setdefault(r["user_id"], set()).add((r["event_time"].date() - day(0)).days)
    assert as_numbers(spark.table(names.states)) == brute_ranges(days, 14, 2)
    assert tables.partition_days(spark, names.snapshot) == [day(2)]


# The ledger


def test_days_without_events_count_as_built(spark, tmp_path, names):  # noqa: F811
    raw = write_raw(spark, tmp_path, [event(2), event(3, user="u_0002")])
    jobs.backfill(spark, raw, day(0), day(1), names, metrics=False)  # nothing at all
    assert jobs.built_days(spark, names) == [day(0), day(1)]
    assert tables.partition_days(spark, names.bitmaps) == []
    jobs.run_day(spark, raw, day(2), names, metrics=False)
    rows = {r.event_date: (r.n_events, r.n_clean) for r in spark.table(names.ledger).collect()}
    assert rows == {day(0): (0, 0), day(1): (0, 0), day(2): (1, 1)}
    with pytest.raises(jobs.MissingDay):
        jobs.run_day(spark, raw, day(4), names, metrics=False)
    with pytest.raises(jobs.MissingDay):
        jobs.backfill(spark, raw, day(-4), day(-2), names, metrics=False)


def test_a_failed_load_is_not_built(spark, tmp_path, names):  # noqa: F811
    good = write_raw(spark, tmp_path, [event(0), event(1), event(2)])
    jobs.backfill(spark, good, day(0), day(1), names, metrics=False)
    bad = write_raw(spark, tmp_path, [event(0), event(1, country="US"), event(2)])
    with pytest.raises(jobs.FailedChecks):
        jobs.run_day(spark, bad, day(1), names, metrics=False)
    assert jobs.built_days(spark, names) == [day(0)]
    with pytest.raises(jobs.MissingDay):
        jobs.run_day(spark, good, day(2), names, metrics=False)
    jobs.run_day(spark, good, day(1), names, metrics=False)
    assert jobs.built_days(spark, names) == [day(0), day(1)]


def test_the_fingerprint_names_a_swapped_row(spark, tmp_path, names):  # noqa: F811
    raw = write_raw(spark, tmp_path, [event(0), event(0, user="u_0002"), event(1)])
    jobs.backfill(spark, raw, day(0), day(1), names, metrics=False)
    swapped = spark.table(names.events).withColumn("country", F.when(F.col("user_id") == "u_0002", "MY").otherwise(F.col("country")))
    tables.replace_days(spark.createDataFrame(swapped.collect(), swapped.schema), names.events, day(0), day(1))
    now = {r.event_date: r.fingerprint for r in jobs.ledger_rows(spark, day(0), day(1), names).collect()}
    held = {r.event_date: (r.n_events, r.fingerprint) for r in spark.table(names.ledger).collect()}
    assert now[day(0)] != held[day(0)][1] and held[day(0)][0] == 2 and now[day(1)] == held[day(1)][1]


def test_tables_without_a_ledger_get_one(spark, tmp_path, names):  # noqa: F811
    raw = write_raw(spark, tmp_path, log(1))
    jobs.backfill(spark, raw, day(0), day(1), names, metrics=False)
    rows = table_rows(spark, names.ledger)
    jobs._forget(spark, day(0), day(1), names)
    spark.sql(f"DROP TABLE {names.ledger}")
    jobs.create_tables(spark, names)
    assert table_rows(spark, names.ledger) == rows


# Rolling users


def test_rolling_users_equal_sets(spark, monkeypatch):
    monkeypatch.setattr(rolling, "SHARES", 3)
    draw = random.Random(2)
    days = {f"u{k}": sorted(draw.sample(range(40), draw.randrange(1, 12))) for k in range(60)}
    rows = activity_rows(spark, days)
    early = rows.where(F.col("event_date") < F.lit(day(20)))
    known = rolling.number_users(spark.createDataFrame([], "user_id string, user_no long"), early)
    known = spark.createDataFrame(known.collect(), known.schema)
    numbers = known.unionByName(rolling.number_users(known, rows))
    numbers = spark.createDataFrame(numbers.collect(), numbers.schema)
    given = [r.user_no for r in numbers.collect()]
    assert len(set(given)) == len(given) == 60 and max(given) < 3 * 40
    found = rolling.rolling_active_users(rolling.daily_bitmaps(rows, numbers), day(0), day(41), (7, 28)).collect()
    assert {(r.event_date, r.window_days): r.active_users for r in found} == {
        (day(n), w): sum(any(n - w < d <= n for d in own) for own in days.values()) for n in range(42) for w in (7, 28)
    }
    assert found[0].event_date + timedelta(days=0) in {day(n) for n in range(42)}


def test_rolling_users_of_nobody(spark):
    nobody = spark.createDataFrame([], "user_id string, event_date date")
    numbers = rolling.number_users(spark.createDataFrame([], "user_id string, user_no long"), nobody)
    found = rolling.rolling_active_users(rolling.daily_bitmaps(nobody, numbers), day(0), day(1), (7,)).collect()
    assert [r.active_users for r in found] == [0, 0]
