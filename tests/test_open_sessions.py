"""Sessions day by day, carried over midnight, against the whole history."""

import random

import pytest
from helpers import day, event, events
from pyspark.sql import functions as F
from test_jobs import names, table_rows, write_raw  # noqa: F401

from retentide.operators import engagement
from retentide.plans import jobs
from retentide.schemas import OPEN_SESSIONS
from retentide.sources import tables


def counted(df):
    return {(r.user_id, r.period_start): (r.active_days, r.sessions, r.sessions_per_active_day) for r in df.collect()}


def night_owls(seed, days, users=12):
    """Users who are mostly active around midnight."""
    draw = random.Random(seed)
    rows = []
    for u in range(users):
        for n in range(days):
            for _ in range(draw.choice([0, 0, 2, 5])):
                hour, minute = draw.choice([(23, draw.randrange(20, 60)), (0, draw.randrange(40)), (draw.randrange(24), 0)])
                rows.append(event(n, user=f"u_{u:04d}", hour=hour, minute=minute))
    return rows


@pytest.mark.parametrize("period", ["day", "week", "month"])
def test_days_add_up_to_the_whole_history(spark, period):
    """25 days, over ends of weeks and of a month."""
    log = events(spark, night_owls(3, 25)).cache()
    still_open = spark.createDataFrame([], OPEN_SESSIONS)
    added = []
    for n in range(25):
        today = log.where(F.col("event_date") == F.lit(day(n)))
        added += engagement.day_sessions(today, still_open, day(n), period).collect()
        still_open = spark.createDataFrame(engagement.open_sessions(today, day(n)).collect(), OPEN_SESSIONS)
    schema = engagement.session_frequency(log, period).schema
    parts = spark.createDataFrame(added, schema)
    assert counted(engagement.merged_sessions(parts, parts.limit(0))) == counted(engagement.session_frequency(log, period))


def test_a_pause_of_just_the_gap_goes_on(spark):
    for minute, sessions in ((0, 0), (1, 1)):
        before = engagement.open_sessions(events(spark, [event(0, hour=23, minute=30)]), day(0))
        assert [r.user_id for r in before.collect()] == ["u_0001"]
        found = engagement.day_sessions(events(spark, [event(1, hour=0, minute=minute)]), before, day(1)).first()
        assert (found.active_days, found.sessions) == (1, sessions)
    assert engagement.open_sessions(events(spark, [event(0, hour=23, minute=29), event(None), event(0, user=None, hour=23, minute=50)]), day(0)).collect() == []


def test_nobody(spark):
    nothing = events(spark, [])
    still_open = engagement.open_sessions(nothing, day(0))
    assert still_open.collect() == [] and engagement.day_sessions(nothing, still_open, day(1)).collect() == []


def test_daily_steps_read_the_day_and_the_open_sessions(spark, tmp_path, names):  # noqa: F811
    rows = night_owls(5, 8)
    raw = write_raw(spark, tmp_path, rows)
    jobs.backfill(spark, raw, day(0), day(1), names)
    for n in range(2, 8):
        # the days before the step are hidden from it
        held = spark.table(names.clean)
        before = spark.createDataFrame(held.collect(), held.schema)
        for k in range(n):
            tables.drop_day(spark, names.clean, day(k))
        jobs.run_day(spark, raw, day(n), names)
        assert tables.partition_days(spark, names.open_sessions) in ([day(n)], [])
        tables.replace_days(before, names.clean, day(0), day(n - 1))
    want = engagement.session_frequency(spark.table(names.clean), "week")
    assert table_rows(spark, names.sessions) == sorted(map(tuple, want.select(*spark.table(names.sessions).columns).collect()), key=str)
    # a day that is loaded once more
    jobs.run_day(spark, raw, day(7), names)
    assert counted(spark.table(names.sessions)) == counted(want)
