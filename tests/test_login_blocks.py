"""Login histories in blocks against the bitmaps of each day."""

import random

import pytest
from helpers import day, event, events
from pyspark.sql import functions as F
from test_jobs import names, other_names, table_rows, write_raw  # noqa: F401

from retentide.operators import bitmaps, login_blocks
from retentide.plans import jobs
from retentide.schemas import LOGIN_BLOCKS
from retentide.sources import tables


def rows_of(df):
    return sorted(map(tuple, df.select(*bitmaps.COLUMNS).collect()), key=str)


def random_rows(seed, days, users=10):
    """Devices that come late, idle over whole blocks, and change their country."""
    draw = random.Random(seed)
    rows = []
    for u in range(users):
        rate, begins = draw.choice([0.02, 0.3]), draw.randrange(days)
        for n in range(begins, days):
            for _ in range(draw.choice([1, 2]) * (draw.random() < rate)):
                rows.append(event(n, user=f"u_{u:04d}", platform=draw.choice(["web", "ios", None]), country=draw.choice(["SG", "MY", None]), hour=draw.randrange(24)))
    return rows


def test_bitmaps_come_back_exactly(spark):
    """110 days touch four or five blocks."""
    log = events(spark, [*random_rows(1, 110), event(None), event(3, user=None)]).cache()
    blocks = login_blocks.login_blocks(log).cache()
    for as_of in (day(0), day(24), day(25), day(57), day(109), day(140)):
        assert rows_of(login_blocks.bitmaps_of(blocks, as_of, as_of)) == rows_of(bitmaps.build_bitmaps(log, as_of, as_of))
    assert rows_of(login_blocks.bitmaps_of(blocks, None, day(70))) == rows_of(bitmaps.build_bitmaps(log, day(70)))


@pytest.mark.parametrize("seed", [1, 2])
def test_days_may_come_in_any_order(spark, seed):
    log = events(spark, random_rows(seed, 40, users=6)).cache()
    held, order = spark.createDataFrame([], LOGIN_BLOCKS), list(range(0, 40, 4))
    random.Random(seed).shuffle(order)
    for n in order:
        some = log.where(F.col("event_date").between(F.lit(day(n)), F.lit(day(n + 3))))
        held = spark.createDataFrame(login_blocks.merged(held, some).collect(), LOGIN_BLOCKS)
    assert sorted(held.collect(), key=str) == sorted(login_blocks.login_blocks(log).collect(), key=str)


def test_the_block_of_a_day():
    starts = [login_blocks.block_start(day(n)) for n in range(100)]
    assert all(0 <= (day(n) - s).days < 32 for n, s in enumerate(starts)) and len(set(starts)) in (4, 5)


@pytest.mark.parametrize("window", [1, 14, 32, 45])
def test_windows_count_the_days_of_a_user_once(spark, window):
    rows = random_rows(7, 120)
    log = events(spark, rows)
    for end in (10, 63, 119):
        active = {(r["user_id"], (r["event_time"].date() - day(0)).days) for r in rows}
        want = {}
        for user, n in active:
            if end - 2 * window < n <= end:
                counts = want.setdefault(user, [0, 0])
                counts[n <= end - window] += 1
        found = login_blocks.window_counts(login_blocks.login_blocks(log), day(end), window).collect()
        assert {r.user_id: [r.current_days, r.prior_days] for r in found} == want


def test_a_window_reads_its_blocks_only(spark, names):  # noqa: F811
    jobs.create_tables(spark, names)
    tables.rebuild(login_blocks.login_blocks(events(spark, random_rows(4, 120))), names.blocks)
    found = login_blocks.window_counts(spark.table(names.blocks), day(119), 14)
    files = {f.split("block=")[1].split("/")[0] for f in found.inputFiles()}
    read = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(block" in read and len(tables.partition_days(spark, names.blocks)) > 3
    assert {str(login_blocks.block_start(day(119)))} <= files


def test_nothing(spark):
    nothing = login_blocks.login_blocks(events(spark, []))
    assert nothing.collect() == [] and login_blocks.merged(nothing, events(spark, [])).collect() == []
    assert login_blocks.bitmaps_of(nothing, None, day(3)).collect() == []
    assert login_blocks.window_counts(nothing, day(3), 2).collect() == []


def test_a_batch_without_stored_bitmaps(spark, tmp_path, names):  # noqa: F811
    """A backfill, days that come before and after it, a day once more, and a day that has become empty."""
    start = 20  # the second block begins on day 25
    rows = [event(start + n % 10, user=f"u_{n % 7:04d}", platform=random.Random(n).choice(["web", "ios"]), hour=n % 24) for n in range(0, 160, 3)]
    raw = write_raw(spark, tmp_path, rows)
    jobs.backfill(spark, raw, day(start + 3), day(start + 6), names, stored=False)
    jobs.backfill(spark, raw, day(start), day(start + 2), names, stored=False)
    for n in (7, 8, 9, 5):
        jobs.run_day(spark, raw, day(start + n), names, stored=False)
    other = other_names()
    jobs.backfill(spark, raw, day(start), day(start + 9), other)
    assert tables.partition_days(spark, names.bitmaps) == []
    assert table_rows(spark, names.blocks) == table_rows(spark, other.blocks)
    assert rows_of(jobs.bitmaps_of_days(spark, day(start), day(start + 9), names)) == rows_of(spark.table(other.bitmaps))
    assert jobs.check_bitmaps(spark, day(start), names, day(start + 9)).where("n_bad > 0").collect() == []
    assert table_rows(spark, names.states) == table_rows(spark, other.states)
    assert table_rows(spark, names.ledger) == table_rows(spark, other.ledger)
    # bitmaps can be stored again from any day on
    jobs.run_day(spark, raw, day(start + 9), names)
    assert rows_of(tables.day_partition(spark, names.bitmaps, day(start + 9))) == rows_of(tables.day_partition(spark, other.bitmaps, day(start + 9)))
    # a day that has become empty, in both
    (tmp_path / "less").mkdir()
    less = write_raw(spark, tmp_path / "less", [r for r in rows if r["event_time"].date() != day(start + 4)])
    jobs.run_day(spark, less, day(start + 4), names, stored=False)
    jobs.run_day(spark, less, day(start + 4), other)
    assert tables.partition_days(spark, names.bitmaps) == []
    assert table_rows(spark, names.blocks) == table_rows(spark, other.blocks)
    assert rows_of(jobs.bitmaps_of_days(spark, day(start), day(start + 9), names)) == rows_of(spark.table(other.bitmaps))
