"""Tables, the raw log, and the daily batch end to end."""

import csv
import os
import subprocess
import sys
import uuid
from dataclasses import fields
from datetime import datetime
from pathlib import Path

import pytest
from helpers import as_numbers, brute_ranges, day, event, events
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retentide.__main__ import parser
from retentide.operators import bitmaps, states
from retentide.plans import jobs
from retentide.schemas import BRONZE_EVENTS, EVENTS, LOGIN_BITMAPS
from retentide.sources import raw_events, tables

HEADER = ",".join(EVENTS.fieldNames())


@pytest.fixture
def names():
    return jobs.TableNames.prefixed(f"t{uuid.uuid4().hex[:8]}")


def other_names():
    return jobs.TableNames.prefixed(f"x{uuid.uuid4().hex[:8]}")


def table_rows(spark, table):
    return sorted(map(tuple, spark.table(table).collect()), key=str)


def one_column_table(spark):
    table = f"t_{uuid.uuid4().hex[:8]}.days"
    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("event_date", T.DateType())])
    assert tables.table_missing(spark, table)
    assert tables.create_day_table(spark, table, schema, "event_date") is True
    assert tables.create_day_table(spark, table, schema, "event_date") is False
    assert not tables.table_missing(spark, table)
    return table


def days_frame(spark, *rows):
    return spark.createDataFrame([(n, day(d)) for n, d in rows], "n long, event_date date")


def test_day_column_has_to_be_a_date(spark):
    with pytest.raises(ValueError):
        tables.create_day_table(spark, "t_bad", EVENTS, "event_time")


def test_replace_day_is_idempotent_and_keeps_other_days(spark):
    table = one_column_table(spark)
    for _ in range(2):
        assert tables.replace_day(days_frame(spark, (1, 0), (2, 0), (9, 1)), table, day(0)) == 2
    tables.replace_day(days_frame(spark, (3, 1)), table, day(1))
    tables.replace_day(days_frame(spark, (4, 0)), table, day(0))
    assert table_rows(spark, table) == [(3, day(1)), (4, day(0))]
    assert tables.partition_exists(spark, table, day(0)) is True
    assert tables.partition_exists(spark, table, day(5)) is False
    assert tables.partition_row_count(spark, table, day(1)) == 1


def test_replacing_with_no_rows_empties_the_day(spark):
    table = one_column_table(spark)
    tables.replace_day(days_frame(spark, (1, 0)), table, day(0))
    tables.replace_day(days_frame(spark, (2, 1)), table, day(1))
    assert tables.replace_day(days_frame(spark), table, day(0)) == 0
    assert table_rows(spark, table) == [(2, day(1))]
    assert tables.partition_days(spark, table) == [day(1)]


def test_a_day_may_be_built_from_the_same_table(spark):
    table = one_column_table(spark)
    tables.replace_day(days_frame(spark, (1, 0)), table, day(0))
    for n in (1, 2):
        prev = tables.day_partition(spark, table, day(n - 1))
        step = prev.select((F.col("n") + 1).alias("n"), F.lit(day(n)).alias("event_date"))
        tables.replace_day(step, table, day(n))
    assert table_rows(spark, table) == [(1, day(0)), (2, day(1)), (3, day(2))]


def test_replace_days_drops_days_that_became_empty(spark):
    table = one_column_table(spark)
    tables.replace_days(days_frame(spark, *[(n, n) for n in range(5)]), table, day(0), day(4))
    tables.replace_days(days_frame(spark, (7, 2), (8, 4)), table, day(1), day(3))
    assert table_rows(spark, table) == [(0, day(0)), (4, day(4)), (7, day(2))]


def test_rebuild_replaces_everything(spark):
    table = one_column_table(spark)
    tables.rebuild(days_frame(spark, (1, 0), (2, 1)), table)
    tables.rebuild(days_frame(spark, (3, 5)), table)
    assert table_rows(spark, table) == [(3, day(5))]
    tables.rebuild(days_frame(spark), table)
    assert table_rows(spark, table) == []


def test_day_filter_prunes_partitions(spark):
    table = one_column_table(spark)
    tables.replace_days(days_frame(spark, (1, 0), (2, 1)), table, day(0), day(1))
    plan = tables.day_partition(spark, table, day(1))._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


# Raw log


def csv_file(tmp_path, *records, header=HEADER):
    path = tmp_path / f"{uuid.uuid4().hex}.csv"
    path.write_text("\n".join([header, *records]) + "\n")
    return str(path)


def test_csv_values_and_time_zones(spark, tmp_path):
    path = csv_file(
        tmp_path,
        "2025-02-06 23:30:00.123456,u_0001,Female,like,,,web,google,SG",
        '2025-02-07 01:00:00+02:00,u_0002,Male,share,"","",ios,organic,MY',
        '2025-02-06 08:00:00 UTC,u_0003,Male,miles_earned,"food, drink",12.5,ios,organic,MY',
    )
    rows = {r.user_id: r for r in raw_events.with_event_date(raw_events.read_raw_events(spark, path)).collect()}
    assert rows["u_0001"].event_time == datetime(2025, 2, 6, 23, 30, 0, 123456)
    assert rows["u_0001"].miles_amount is None and rows["u_0001"].transaction_category is None
    # The day is the UTC day, not the text before the offset.
    assert rows["u_0002"].event_date == day(0)
    assert rows["u_0002"].miles_amount is None and rows["u_0002"].transaction_category is None
    assert rows["u_0003"].transaction_category == "food, drink" and rows["u_0003"].miles_amount == 12.5


@pytest.mark.parametrize(
    "record",
    ["2025-02-06 10:00:00,u_0001,Female,miles_earned,food,many,web,google,SG",
     "not a time,u_0001,Female,like,,,web,google,SG"],
)
def test_bad_csv_record_fails_the_load(spark, tmp_path, record):
    path = csv_file(tmp_path, record)
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        raw_events.read_raw_events(spark, path).collect()


def test_other_header_fails_the_load(spark, tmp_path):
    path = csv_file(tmp_path, "a,b,c,d,e,1.0,g,h,i", header=HEADER.replace("gender", "sex"))
    with pytest.raises(Exception, match="(?i)header"):
        raw_events.read_raw_events(spark, path).collect()


# The daily batch


def write_raw(spark, tmp_path, rows):
    path = str(tmp_path / uuid.uuid4().hex)
    raw_events.write_raw_events(events(spark, rows), path)
    return path


def log(last):
    """Days 0 to ``last``; day 3 has no events."""
    rows = []
    for u in range(6):
        for n in range(last + 1):
            if n != 3 and (u * 3 + n * n) % 5 < 2:
                platform = ("android", "ios", "web")[(u + n // 2) % 3]
                rows.append(event(n, user=f"u_{u:04d}", platform=platform, kind="miles_earned"))
                rows.append(event(n, user=f"u_{u:04d}", platform=platform, hour=13))
    return rows


def snapshot(spark, names):
    return [table_rows(spark, getattr(names, f.name)) for f in fields(names)]


def test_daily_runs_equal_the_backfill(spark, tmp_path, names):
    rows = log(6)
    raw = write_raw(spark, tmp_path, rows)
    for n in range(7):
        counts = jobs.run_day(spark, raw, day(n), names, metrics=False)
        assert counts["events"] == sum(1 for r in rows if r["event_time"].date() == day(n))
        assert {r.n_bad for r in jobs.check_bitmaps(spark, day(n), names).collect()} == {0}
        bad = {r.check: r.n_bad for r in jobs.check_bronze(spark, raw, day(n), names).collect()}
        empty = {"table_not_empty", "source_not_empty"} if n == 3 else set()
        assert {c for c, k in bad.items() if k} == empty
    daily = snapshot(spark, names)

    days = {}
    for r in rows:
        days.setdefault(r["user_id"], set()).add((r["event_time"].date() - day(0)).days)
    assert as_numbers(spark.table(names.states)) == brute_ranges(days, 14, 6)

    other = other_names()
    jobs.backfill(spark, raw, day(0), day(6), other, metrics=False)
    assert snapshot(spark, other) == daily

    # All partitions read as bitmaps give the same ranges as the last one read as activity.
    whole = states.user_states_from_bitmaps(spark.table(names.bitmaps))
    assert as_numbers(whole) == as_numbers(spark.table(names.states))

    jobs.run_day(spark, raw, day(6), names, metrics=False)
    assert snapshot(spark, names) == daily


def test_late_events_rebuild_the_days_after(spark, tmp_path, names):
    rows = log(5)
    early = [r for r in rows if not (r["user_id"] == "u_0001" and r["event_time"].date() == day(1))]
    jobs.backfill(spark, write_raw(spark, tmp_path, early + [event(5, user="u_0009")]), day(0), day(5), names, metrics=False)
    late = write_raw(spark, tmp_path, rows + [event(2, user="u_0009"), event(5, user="u_0009")])
    jobs.run_day(spark, late, day(1), names, metrics=False)
    jobs.run_day(spark, late, day(2), names, metrics=False)
    rerun = snapshot(spark, names)
    other = other_names()
    jobs.backfill(spark, late, day(0), day(5), other, metrics=False)
    assert snapshot(spark, other) == rerun


def test_a_skipped_day_is_refused(spark, tmp_path, names):
    raw = write_raw(spark, tmp_path, log(4))
    jobs.run_day(spark, raw, day(0), names, metrics=False)
    with pytest.raises(jobs.MissingDay):
        jobs.run_day(spark, raw, day(2), names, metrics=False)
    with pytest.raises(jobs.MissingDay):
        jobs.backfill(spark, raw, day(2), day(4), names, metrics=False)
    with pytest.raises(jobs.MissingDay):
        jobs.rebuild_states(spark, day(1), names)


def test_a_day_that_lost_its_events_ends_up_empty(spark, tmp_path, names):
    jobs.run_day(spark, write_raw(spark, tmp_path, log(1)), day(0), names, metrics=False)
    nothing = write_raw(spark, tmp_path, [r for r in log(1) if r["event_time"].date() != day(0)])
    counts = jobs.run_day(spark, nothing, day(0), names, metrics=False)
    assert counts == {"events": 0, "clean": 0, "bitmaps": 0, "activity": 0}
    assert not any(snapshot(spark, names))


def test_tables_keep_their_contract(spark, names):
    jobs.create_tables(spark, names)
    assert spark.table(names.events).columns == BRONZE_EVENTS.fieldNames()
    assert sorted(spark.table(names.bitmaps).columns) == sorted(LOGIN_BITMAPS.fieldNames())
    assert not tables.has_rows(spark.table(names.states))


def test_bucketed_bitmaps_join_without_moving_yesterday(spark, tmp_path, names):
    raw = write_raw(spark, tmp_path, log(4))
    jobs.create_tables(spark, names, bitmap_buckets=4)
    assert tables.buckets_of(spark, names.bitmaps) == tables.Buckets("device", 4)
    for n in range(5):
        jobs.run_day(spark, raw, day(n), names, metrics=False)
    other = other_names()
    jobs.create_tables(spark, other, bitmap_buckets=4)
    jobs.backfill(spark, raw, day(0), day(4), other, metrics=False)
    assert snapshot(spark, other) == snapshot(spark, names)
    for part in range(5):
        files = spark.table(names.bitmaps).where(F.col("event_date") == F.lit(day(part))).inputFiles()
        assert len(files) <= 4

    step = bitmaps.carry_forward(
        tables.day_partition(spark, names.bitmaps, day(3)),
        tables.day_partition(spark, names.events, day(4)),
        day(4),
    )
    side = joined_side(step, names.bitmaps.split(".")[1])
    assert "Exchange" not in side and "Bucketed: true" in side


def joined_side(df, table):
    """The part of the plan between the scan of ``table`` and the join above it."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and f".{table}[" in line)
    join = max(i for i in range(scan) if "Join" in lines[i])
    depth = lines[scan].index("FileScan")
    side, low = [], depth
    for line in reversed(lines[join + 1 : scan + 1]):
        start = len(line) - len(line.lstrip(" :+-*"))
        if start <= low:
            side.append(line)
            low = start
    return "\n".join(side)


def test_metrics_tables_follow_from_the_activity(spark, tmp_path, names):
    raw = write_raw(spark, tmp_path, log(6))
    jobs.backfill(spark, raw, day(0), day(6), names)
    for _ in range(2):
        jobs.rebuild_metrics(spark, day(6), names)
    growth = spark.table(names.growth).where("period = 'day'").collect()
    engaged = spark.table(names.engagement).where("period = 'day'").collect()
    active = {r.period_start: r.active_users for r in growth if r.active_users}
    assert active == {r.period_start: r.active_users for r in engaged}
    assert spark.table(names.growth).select("period").distinct().count() == 3
    users = spark.table(names.cohorts).where("day_offset = 1").agg(F.sum("cohort_size")).first()[0]
    assert users == len({r["user_id"] for r in log(6)})
    assert spark.table(names.balance).count() == spark.table(names.activity).count()


def test_command_line_arguments():
    args = parser().parse_args(["backfill", "20250206", "20250301", "--raw", "x.csv"])
    assert (args.job, args.first, args.last, args.raw) == ("backfill", day(0), day(23), "x.csv")
    assert parser().parse_args(["create", "--bitmap-buckets", "8"]).bitmap_buckets == 8
    with pytest.raises(SystemExit):
        parser().parse_args(["run-day", "2025-02-06", "--raw", "x.csv"])


@pytest.mark.parametrize("buckets", [None, 3])
def test_a_long_backfill_equals_the_definition(spark, tmp_path, names, buckets):
    days = {f"u_{u:04d}": [n for n in range(u, 110) if (n * (u + 3)) % 17 == 0 or n == u] for u in range(9)}
    feed = [event(n, user=u) for u, ns in days.items() for n in ns]
    jobs.create_tables(spark, names, bitmap_buckets=buckets)
    jobs.backfill(spark, write_raw(spark, tmp_path, feed), day(0), day(110), names, metrics=False)
    got = {(r.user_id, r.event_date): r.login_bitmap for r in spark.table(names.bitmaps).collect()}
    assert got == {
        (u, day(n)): "".join("1" if d in ns else "0" for d in range(ns[0], n + 1))
        for u, ns in days.items() for n in range(ns[0], 111)
    }
    assert as_numbers(spark.table(names.states)) == brute_ranges(days, 14, 110)


def test_backfills_in_any_order_give_the_same_tables(spark, tmp_path, names):
    raw = write_raw(spark, tmp_path, log(7))
    for first, last in ((6, 7), (3, 5), (0, 2), (4, 4)):
        jobs.backfill(spark, raw, day(first), day(last), names)
    other = other_names()
    jobs.backfill(spark, raw, day(0), day(7), other)
    assert snapshot(spark, names) == snapshot(spark, other)
    with pytest.raises(jobs.MissingDay):
        jobs.backfill(spark, raw, day(-5), day(-3), names)


def test_a_rebuild_reads_only_what_changed(spark, tmp_path, names):
    raw = write_raw(spark, tmp_path, log(8))
    jobs.backfill(spark, raw, day(0), day(8), names, metrics=False)
    whole = table_rows(spark, names.bitmaps)
    # events before the range may be gone
    for n in range(5):
        tables.drop_day(spark, names.clean, day(n))
        tables.drop_day(spark, names.events, day(n))
    jobs.rebuild_bitmaps(spark, day(5), day(8), names)
    assert table_rows(spark, names.bitmaps) == whole
    prev = tables.day_partition(spark, names.bitmaps, day(4))
    built = bitmaps.build_bitmaps(jobs._days(spark, names.clean, day(5), day(8)), day(8), day(5), None, prev)
    plan = built._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line and ".events_clean[" in line)
    assert f"(event_date" in scan and f">= {day(5)}" in scan and f"<= {day(8)}" in scan


def test_states_come_from_active_days(spark, tmp_path, names):
    jobs.backfill(spark, write_raw(spark, tmp_path, log(8)), day(0), day(8), names, metrics=False)
    active = spark.table(names.activity).select("user_id", "event_date")
    plan = states.user_states(active, day(8))._jdf.queryExecution().executedPlan().toString()
    assert "login_bitmap" not in plan


def test_copies_and_rows_without_time(spark, tmp_path, names):
    rows = [event(0, kind="miles_earned"), event(0, kind="miles_earned"), event(0, user="u_0002")]
    jobs.run_day(spark, write_raw(spark, tmp_path, rows), day(0), names, metrics=False)
    daily = {r.user_id: r for r in spark.table(names.activity).collect()}
    assert (daily["u_0001"].total_events, float(daily["u_0001"].miles_earned_sum)) == (1, 10.0)
    assert spark.table(names.events).count() == 3 and spark.table(names.clean).count() == 2
    lost = write_raw(spark, tmp_path, rows + [event(None)])
    assert {r.check: r.n_bad for r in jobs.check_bronze(spark, lost, day(0), names).collect()}["event_time_not_null"] == 1
    with pytest.raises(jobs.FailedChecks, match="event_time_not_null"):
        jobs.run_day(spark, lost, day(0), names, metrics=False)
    assert jobs.run_day(spark, lost, day(0), names, strict=False, metrics=False)["clean"] == 2


def test_bad_events_stop_the_load_before_silver(spark, tmp_path, names):
    raw = write_raw(spark, tmp_path, [event(0), event(0, user="u_0002", country="US")])
    with pytest.raises(jobs.FailedChecks, match="country_known"):
        jobs.run_day(spark, raw, day(0), names, metrics=False)
    assert table_rows(spark, names.bitmaps) == []


def test_balances_are_exact_and_go_on(spark, tmp_path, names):
    rows = [event(n, kind="miles_earned", hour=h, miles_amount=0.1) for n in range(3) for h in range(10)]
    raw = write_raw(spark, tmp_path, rows)
    for n in range(3):
        jobs.run_day(spark, raw, day(n), names)
    jobs.run_day(spark, raw, day(1), names)
    got = {r.event_date: str(r.miles_balance) for r in spark.table(names.balance).collect()}
    assert got == {day(n): f"{n + 1}.00" for n in range(3)}


def test_a_failing_rebuild_keeps_the_old_rows(spark):
    table = one_column_table(spark)
    tables.rebuild(days_frame(spark, (1, 0), (2, 1)), table)
    broken = days_frame(spark, (3, 1), (4, 2)).repartition(1).withColumn("n", F.expr("if(n = 4, raise_error('no')::long, n)"))
    with pytest.raises(Exception, match="no"):
        tables.rebuild(broken, table)
    assert table_rows(spark, table) == [(1, day(0)), (2, day(1))]


def test_days_below_a_dated_path(spark, tmp_path, names):
    for n in range(3):
        raw_events.write_raw_events(events(spark, [event(n, user=f"u_000{n}")]), str(tmp_path / "landing" / str(day(n))))
    pattern = str(tmp_path / "landing" / "{day}")
    jobs.backfill(spark, pattern, day(0), day(1), names, metrics=False)
    jobs.run_day(spark, pattern, day(2), names, metrics=False)
    assert spark.table(names.events).count() == 3
    assert len(jobs.read_raw(spark, pattern, day(1)).inputFiles()) < 3


def test_csv_written_by_the_csv_module(spark, tmp_path):
    odd = ['Joe "X" Cafe', 'C:\\dir"', 'Bob "Y", Inc', "  blanks  ", "\\", '"', 'a\\"b', ",", "'"]
    path = tmp_path / "odd.csv"
    with path.open("w", newline="") as f:
        writer = csv.writer(f)
        writer.writerow(EVENTS.fieldNames())
        for i, text in enumerate(odd):
            writer.writerow([f"2025-02-06 10:00:{i:02d}", f"u_{i:04d}", "Male", "miles_earned", text, 1.5, "web", "google", "SG"])
    raw = raw_events.read_raw_events(spark, str(path))
    assert [r.transaction_category for r in raw.orderBy("user_id").collect()] == odd
    # also when only some columns are read
    assert {tuple(r) for r in raw.select("platform", "country").collect()} == {("web", "SG")}
    back = str(tmp_path / "back")
    raw_events.write_raw_events(raw, back)
    assert [r.transaction_category for r in raw_events.read_raw_events(spark, back).orderBy("user_id").collect()] == odd


def test_line_breaks_in_quotes_are_refused_or_read_whole(spark, tmp_path):
    path = csv_file(tmp_path, '2025-02-06 10:00:00,u_0001,Female,miles_earned,"two\nlines",1.0,web,google,SG')
    for columns in (["*"], ["platform"]):
        with pytest.raises(Exception, match="(?i)malformed|parse"):
            raw_events.read_raw_events(spark, path).select(*columns).collect()
    assert raw_events.read_raw_events(spark, path, multiline=True).first().transaction_category == "two\nlines"


def test_two_processes_work_on_one_warehouse(spark, tmp_path, names):
    """Each day in a process of its own, as the command line runs; then the tables of one backfill."""
    raw = write_raw(spark, tmp_path, log(1))
    conf = f"--conf spark.sql.warehouse.dir={tmp_path}/wh --conf spark.ui.enabled=false --conf spark.sql.shuffle.partitions=2"
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": f"--master local[2] {conf} pyspark-shell", "PYTHONPATH": str(Path(jobs.__file__).parents[2])}
    command = lambda *args: subprocess.run([sys.executable, "-m", "retentide", *args], env=env, capture_output=True, text=True, timeout=300)
    text = lambda n: day(n).strftime("%Y%m%d")
    assert command("create", "--bitmap-buckets", "2").returncode == 0
    for n in range(2):
        done = command("run-day", text(n), "--raw", raw)
        assert done.returncode == 0, done.stderr[-2000:]
    assert command("check", text(1), "--raw", raw).returncode == 0
    assert command("check", text(1), "--raw", write_raw(spark, tmp_path, log(0))).returncode == 1
    jobs.backfill(spark, raw, day(0), day(1), names)
    defaults = jobs.TableNames()
    for f in fields(names):
        database, table = getattr(defaults, f.name).split(".")
        mine = spark.table(getattr(names, f.name))
        theirs = spark.read.schema(mine.schema).parquet(f"{tmp_path}/wh/{database}.db/{table}")
        assert sorted(map(tuple, theirs.collect()), key=str) == sorted(map(tuple, mine.collect()), key=str), f.name
