"""The daily batch: raw CSV to bronze events, cleaned events, silver bitmaps and activity, gold tables.

Every job can be run again for the same day, and days can be loaded in any order as long as they
leave no gap: a day before the latest one also rebuilds what follows from it. Only this module and
``sources.tables`` write.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, fields
from datetime import date, timedelta
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retentide import schemas
from retentide.functions.calendar import PERIODS, period_from_index, period_index, period_start
from retentide.operators import activity, bitmaps, cleaning, engagement, growth, login_blocks, quality, reconcile, rolling, snapshot, states
from retentide.session import require_utc
from retentide.sources import published, raw_events, tables

# Rows of bitmaps that a task of a backfill writes.
TASK_ROWS = 2_000_000
SESSION_PERIOD = "week"
# Checks that report but don't stop a load: a day may have no events.
REPORTED_ONLY = ("table_not_empty", "source_not_empty")


def _beside(table: str, name: str) -> str:
    """Another table of the same database."""
    return f"{table.rpartition('.')[0]}.{name}"


@dataclass(frozen=True)
class TableNames:
    events: str = "bronze.events"
    bitmaps: str = "silver.fct_daily_user_login_bitmap"
    activity: str = "silver.dwm_user_daily_activity"
    states: str = "gold.scd2_user_state"
    clean: str = "bronze.events_clean"
    balance: str = "silver.dwm_user_miles_balance"
    sources: str = "silver.dwm_active_users_by_source"
    sessions: str = "silver.dwm_session_frequency"
    growth: str = "gold.dws_growth_accounting"
    cohorts: str = "gold.dws_cohort_retention"
    engagement: str = "gold.dws_engagement_depth"
    active_users: str = "gold.dws_active_users"

    # What the batch itself keeps, beside the tables of its contract.

    @property
    def ledger(self) -> str:
        return _beside(self.events, "load_ledger")

    @property
    def raw_files(self) -> str:
        return _beside(self.events, "raw_log_files")

    @property
    def blocks(self) -> str:
        return _beside(self.bitmaps, "fct_login_blocks")

    @property
    def open_sessions(self) -> str:
        return _beside(self.sessions, "dwm_open_sessions")

    @property
    def snapshot(self) -> str:
        return _beside(self.activity, "dwm_user_snapshot")

    @property
    def numbers(self) -> str:
        return _beside(self.activity, "dwm_user_numbers")

    @property
    def active_bitmaps(self) -> str:
        return _beside(self.activity, "dwm_active_bitmaps")

    @property
    def rolling(self) -> str:
        return _beside(self.growth, "dws_rolling_active_users")

    @property
    def for_readers(self) -> list[str]:
        """The tables of the contract, the ledger of the days they hold, and what they are kept in more briefly."""
        return [*(getattr(self, f.name) for f in fields(self)), self.blocks, self.rolling, self.ledger]

    @classmethod
    def prefixed(cls, prefix: str) -> TableNames:
        """The same tables in databases of their own."""
        return cls(*(f"{prefix}_{f.default}" for f in fields(cls)))


class MissingDay(RuntimeError):
    """A step whose neighbouring day has not been built."""


class FailedChecks(RuntimeError):
    """A load that its data-quality checks stopped."""


class Unsettled(RuntimeError):
    """Tables of which some hold days that others don't have yet."""


def create_tables(
    spark: SparkSession, names: TableNames = TableNames(), bitmap_buckets: int | None = None
) -> None:
    """Create the tables that do not exist, or register those that an earlier process wrote.

    ``bitmap_buckets`` splits each day of bitmaps by device. Yesterday's bitmaps, the largest
    input of the daily step, then stay where they are and only today's devices are shuffled.
    """
    require_utc(spark)
    buckets = tables.Buckets("device", bitmap_buckets) if bitmap_buckets else None
    tables.create_day_table(spark, names.events, schemas.BRONZE_EVENTS, "event_date")
    tables.create_day_table(spark, names.clean, schemas.CLEAN_EVENTS, "event_date")
    tables.create_day_table(spark, names.bitmaps, schemas.LOGIN_BITMAPS, "event_date", buckets)
    tables.create_day_table(spark, names.blocks, schemas.LOGIN_BLOCKS, "block")
    tables.create_day_table(spark, names.activity, schemas.USER_DAILY_ACTIVITY, "event_date")
    tables.create_day_table(spark, names.states, schemas.USER_STATE_RANGES, "start_date")
    tables.create_day_table(spark, names.balance, schemas.USER_MILES_BALANCE, "event_date")
    tables.create_day_table(spark, names.sources, schemas.ACTIVE_BY_SOURCE, "event_date")
    tables.create_day_table(spark, names.sessions, schemas.SESSION_FREQUENCY, "period_start")
    tables.create_day_table(spark, names.snapshot, schemas.USER_SNAPSHOT, "event_date")
    tables.create_day_table(spark, names.numbers, schemas.USER_NUMBERS, "event_date")
    tables.create_day_table(spark, names.active_bitmaps, schemas.ACTIVE_BITMAPS, "event_date")
    tables.create_day_table(spark, names.open_sessions, schemas.OPEN_SESSIONS, "event_date")
    tables.create_table(spark, names.raw_files, schemas.RAW_FILES, "log_id")
    # Serving tables of a few rows a day: a partition for each period or offset, not for each day.
    tables.create_table(spark, names.rolling, schemas.ROLLING_USERS, "window_days")
    tables.create_table(spark, names.growth, schemas.GROWTH_ACCOUNTING, "period")
    tables.create_table(spark, names.engagement, schemas.ENGAGEMENT_DEPTH, "period")
    tables.create_table(spark, names.active_users, schemas.ACTIVE_USERS, "period")
    tables.create_table(spark, names.cohorts, schemas.COHORT_RETENTION, "day_offset")
    if tables.create_day_table(spark, names.ledger, schemas.LOAD_LEDGER, "event_date"):
        # tables that were written before there was a ledger
        old = tables.partition_days(spark, names.bitmaps)
        if old and not built_days(spark, names):
            _record(spark, old[0], old[-1], names)


# The ledger of loaded days


def built_days(spark: SparkSession, names: TableNames = TableNames()) -> list[date]:
    """The days whose load is complete up to the bitmaps, those without events included."""
    return tables.partition_days(spark, names.ledger)


def ledger_rows(spark: SparkSession, first: date, last: date, names: TableNames = TableNames()) -> DataFrame:
    """What the ledger has to say of some days: rows of bronze and of the cleaned events, and the fingerprint
    of bronze; a row for each day."""
    calendar = spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("event_date"))
    events = _days(spark, names.events, first, last).groupBy("event_date").agg(F.count(F.lit(1)).alias("n_events"), reconcile.fingerprint(schemas.EVENTS.fieldNames()).cast("string").alias("fingerprint"))
    clean = _days(spark, names.clean, first, last).groupBy("event_date").agg(F.count(F.lit(1)).alias("n_clean"))
    found = calendar.join(events, "event_date", "left").join(clean, "event_date", "left")
    return found.fillna(0, ["n_events", "n_clean"]).fillna("0", ["fingerprint"])


def _record(spark: SparkSession, first: date, last: date, names: TableNames) -> None:
    """Enter days into the ledger; written last, so that a day of a broken load doesn't count as built."""
    tables.replace_days(ledger_rows(spark, first, last, names), names.ledger, first, last)


def _forget(spark: SparkSession, first: date, last: date, names: TableNames) -> None:
    """Take days out of the ledger before their events change, until they are built again."""
    if tables.table_missing(spark, names.ledger):
        return
    for day in built_days(spark, names):
        if first <= day <= last:
            tables.drop_day(spark, names.ledger, day)


def log_index(spark: SparkSession, raw_path: str, names: TableNames = TableNames()) -> DataFrame | None:
    """The index of a raw log's files, brought up to date: files that are new or have changed are read once,
    those that are gone leave it. None for a log of a single file."""
    log_id, key = hashlib.md5(raw_path.encode()).hexdigest(), [*raw_events.FILE_KEY]
    held = spark.table(names.raw_files).where(F.col("log_id") == log_id).drop("log_id")
    now = raw_events.list_files(spark, raw_path)
    sides = now.withColumn("here", F.lit(1)).join(held.select(*key, F.lit(1).alias("known")), key, "full")
    n = sides.agg(F.count("here").alias("here"), F.count("known").alias("known"), F.count(F.col("here") + F.col("known")).alias("both")).first()
    if n["here"] < 2:
        return None
    if n["here"] > n["both"] or n["known"] > n["both"]:
        fresh = raw_events.index_files(spark, now.join(held, key, "left_anti"))
        rows = held.join(now, key, "left_semi").unionByName(fresh).withColumn("log_id", F.lit(log_id))
        tables.replace_where(rows, names.raw_files, F.lit(True), lambda v: v == log_id)
    return spark.table(names.raw_files).where(F.col("log_id") == log_id)


def read_raw(
    spark: SparkSession, raw_path: str, first: date, last: date | None = None, names: TableNames = TableNames()
) -> DataFrame:
    """The raw events of some days, and maybe others. Of a log without folders of days only the files that its
    index names are opened; a log of a single file is read whole, as it changes whenever events come in."""
    if "{day}" in raw_path or tables.table_missing(spark, names.raw_files):
        return raw_events.read_raw_events(spark, raw_events.paths_of_days(raw_path, first, last))
    index = log_index(spark, raw_path, names)
    if index is None:
        return raw_events.read_raw_events(spark, raw_path)
    return raw_events.read_files(spark, raw_events.files_of_days(index, first, last))


def load_bronze(
    spark: SparkSession, raw_path: str, day: date, names: TableNames = TableNames()
) -> int:
    """Replace one day of bronze events from the raw log; returns the number of rows."""
    _forget(spark, day, day, names)
    raw = read_raw(spark, raw_path, day, names=names)
    events = raw_events.with_event_date(raw_events.day_slice(raw, day))
    return tables.replace_day(events, names.events, day)


def load_bronze_days(
    spark: SparkSession, raw_path: str, first: date, last: date, names: TableNames = TableNames()
) -> None:
    """Replace many days of bronze events in one pass over the raw log."""
    _forget(spark, first, last, names)
    raw = raw_events.day_slice(read_raw(spark, raw_path, first, last, names), first, last)
    tables.replace_days(raw_events.with_event_date(raw), names.events, first, last)


def _days(spark: SparkSession, table: str, first: date, last: date) -> DataFrame:
    return spark.table(table).where(F.col("event_date").between(F.lit(first), F.lit(last)))


def clean_days(
    spark: SparkSession, first: date, last: date, names: TableNames = TableNames()
) -> None:
    """Replace the cleaned events of some days; bronze itself stays as it was loaded."""
    events = _days(spark, names.events, first, last)
    tables.replace_days(cleaning.clean(events), names.clean, first, last)


def step_blocks(spark: SparkSession, first: date, last: date, names: TableNames = TableNames()) -> None:
    """Bring the login blocks of some days up to date with the cleaned events.

    Days that the blocks don't have yet are added to them; nothing but those days' events and the blocks they are in
    is read, whatever days come later. Where one of the days is loaded again, the blocks are built from their events.
    """
    if tables.table_missing(spark, names.blocks):
        return
    if not tables.partition_days(spark, names.blocks):
        # the first load, or days that were loaded before there was such a table
        tables.rebuild(login_blocks.login_blocks(spark.table(names.clean)), names.blocks)
        return
    low, high = login_blocks.block_start(first), login_blocks.block_start(last)
    touched = F.col("block").between(F.lit(low), F.lit(high))
    held = spark.table(names.blocks).where(touched)
    if tables.has_rows(held.where(login_blocks.days_between(first, last) != 0)):
        events = _days(spark, names.clean, low, high + timedelta(days=login_blocks.BLOCK_DAYS - 1))
        rows = login_blocks.login_blocks(events)
    else:
        rows = login_blocks.merged(held, _days(spark, names.clean, first, last))
    tables.replace_where(rows, names.blocks, touched, lambda v: low <= date.fromisoformat(v) <= high)


def bitmaps_of_days(spark: SparkSession, first: date, last: date, names: TableNames = TableNames()) -> DataFrame:
    """The login bitmaps of some days: as they are stored, or else made from the blocks."""
    stored = any(first <= d <= last for d in tables.partition_days(spark, names.bitmaps))
    if stored or tables.table_missing(spark, names.blocks):
        return _days(spark, names.bitmaps, first, last)
    return login_blocks.bitmaps_of(spark.table(names.blocks), first, last).where(F.col("event_date") <= F.lit(last))


def _blocks_only(spark: SparkSession, first: date, last: date, names: TableNames) -> None:
    """Build some days without storing their bitmaps; those stored from ``first`` on go, as they are of other days."""
    step_blocks(spark, first, last, names)
    for day in tables.partition_days(spark, names.bitmaps):
        if day >= first:
            tables.drop_day(spark, names.bitmaps, day)
    _record(spark, first, last, names)


def step_bitmaps(
    spark: SparkSession, day: date, names: TableNames = TableNames(), key: str = "device"
) -> int:
    """Build one day of login bitmaps from the day before.

    The table may be empty before ``day``, but it must not have a gap: a missing day before
    would turn every user into a new one. Later days are built on this one, so they have to
    be rebuilt with :func:`rebuild_bitmaps` when it changes.
    """
    built = built_days(spark, names)
    before = day - timedelta(days=1)
    if before not in built and any(d < day for d in built):
        raise MissingDay(f"{names.bitmaps} has earlier days but not {before}")
    prev = bitmaps_of_days(spark, before, before, names)
    events = tables.day_partition(spark, names.clean, day)
    in_buckets = (
        key == "device"
        and before in tables.partition_days(spark, names.bitmaps)
        and tables.buckets_of(spark, names.bitmaps) is not None
    )
    n = tables.replace_day(
        bitmaps.carry_forward(prev, events, day, key), names.bitmaps, day, laid_out=in_buckets
    )
    _record(spark, day, day, names)
    return n


def rebuild_bitmaps(
    spark: SparkSession,
    from_day: date,
    as_of: date,
    names: TableNames = TableNames(),
    loaded_to: date | None = None,
) -> None:
    """Rebuild the login bitmaps of all days from ``from_day`` to ``as_of`` at once.

    Reads the bitmaps of the day before ``from_day`` and the events since, nothing older. The days up to
    ``loaded_to``, or all of them, are entered in the ledger.
    """
    before = from_day - timedelta(days=1)
    built = built_days(spark, names)
    if before not in built and any(d < from_day for d in built):
        raise MissingDay(f"{names.bitmaps} has earlier days but not {before}")
    buckets = tables.buckets_of(spark, names.bitmaps)
    prev = bitmaps_of_days(spark, before, before, names)
    events = _days(spark, names.clean, from_day, as_of)
    # At most so many rows come out: a bound of the devices for each day of the range.
    devices = prev.count() + events.select("platform", "user_id").distinct().count()
    tasks = max(1, -(-devices * ((as_of - from_day).days + 1) // TASK_ROWS))
    rows = bitmaps.build_bitmaps(events, as_of, from_day, buckets and buckets.number, prev, tasks)
    tables.replace_days(rows, names.bitmaps, from_day, as_of, laid_out=True)
    _record(spark, from_day, loaded_to or as_of, names)


def bitmaps_and_later(spark: SparkSession, day: date, names: TableNames = TableNames()) -> int:
    """Clean a day, build its bitmaps and rebuild those of the days after it; returns the day's rows."""
    end = _range_end(spark, day, day, names)
    clean_days(spark, day, day, names)
    step_blocks(spark, day, day, names)
    if end == day:
        return step_bitmaps(spark, day, names)
    rebuild_bitmaps(spark, day, end, names, day)
    return tables.partition_row_count(spark, names.bitmaps, day)


def step_activity(spark: SparkSession, day: date, names: TableNames = TableNames()) -> int:
    _forget_snapshots(spark, day, names)
    events = tables.day_partition(spark, names.clean, day)
    return tables.replace_day(activity.user_daily_activity(events), names.activity, day)


def step_activity_days(
    spark: SparkSession, first: date, last: date, names: TableNames = TableNames()
) -> None:
    _forget_snapshots(spark, first, names)
    daily = activity.user_daily_activity(_days(spark, names.clean, first, last))
    tables.replace_days(daily, names.activity, first, last)


def rebuild_states(
    spark: SparkSession,
    as_of: date,
    names: TableNames = TableNames(),
    window: int = schemas.DEFAULT_WINDOW,
) -> None:
    """Rebuild the state ranges from the active days of all users up to ``as_of``."""
    built = built_days(spark, names)
    if built and as_of not in built:
        raise MissingDay(f"{names.bitmaps} has no {as_of}")
    _forget_snapshots(spark, date.min, names)
    active = spark.table(names.activity).select("user_id", "event_date")
    tables.rebuild(states.user_states(active, as_of, window), names.states)


def rebuild_metrics(
    spark: SparkSession, as_of: date, names: TableNames = TableNames(), from_day: date | None = None
) -> None:
    """Rebuild the serving tables up to ``as_of``.

    ``from_day`` is the first day that changed: balances, channels and sessions of the days before
    stay as they are. Growth, cohorts and depth depend on every user's whole history and are rebuilt.
    """
    _forget_snapshots(spark, date.min, names)
    daily = spark.table(names.activity).where(F.col("event_date") <= F.lit(as_of))
    first = from_day or _first_day(spark, names)

    def by_period(metric: Callable[[str], DataFrame]) -> DataFrame:
        parts = [metric(p).withColumn("period", F.lit(p)) for p in PERIODS]
        return reduce(DataFrame.unionByName, parts)

    def grown() -> None:
        tables.rebuild(by_period(lambda p: growth.growth_accounting(daily, p, as_of)), names.growth)
        _active_users(spark, names)

    work = [
        grown,
        lambda: tables.rebuild(growth.cohort_retention(daily, as_of), names.cohorts),
        lambda: tables.rebuild(by_period(lambda p: engagement.engagement_depth(daily, p)), names.engagement),
    ]
    if first:
        events = _days(spark, names.clean, first, as_of)
        work += [
            lambda: tables.replace_days(activity.user_miles_balance(daily, first), names.balance, first, as_of),
            lambda: tables.replace_days(activity.active_users_by_source(events), names.sources, first, as_of),
            lambda: _rebuild_sessions(spark, first, as_of, names),
            lambda: _rolling(spark, first, as_of, names),
        ]
    _at_once(spark, work)


def _at_once(spark: SparkSession, work: list[Callable[[], object]]) -> None:
    """Run jobs that write different tables side by side, as each leaves tasks free while it starts and ends;
    fails, once all have ended, if one of them fails."""
    with ThreadPoolExecutor(len(work)) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(step)) for step in work]:
            done.result()


def _active_users(spark: SparkSession, names: TableNames) -> None:
    """Active and new users are columns of the growth table by now."""
    counted = spark.table(names.growth).select("period", "period_start", "active_users", "new_users")
    tables.rebuild_small(counted.where("active_users > 0"), names.active_users)


def number_users_of(spark: SparkSession, first: date, last: date, names: TableNames = TableNames()) -> None:
    """Number the users that come up in some days for the first time, and rebuild these days' bitmaps of users.

    A number stays with its user, whatever happens to the day on which it was given, so only days that changed
    are built again."""
    active = _days(spark, names.activity, first, last).select("user_id", "event_date")
    fresh = rolling.number_users(spark.table(names.numbers), active).withColumn("event_date", F.lit(first))
    given = tables.day_partition(spark, names.numbers, first)
    tables.replace_day(given.unionByName(fresh), names.numbers, first)
    tables.replace_days(rolling.daily_bitmaps(active, spark.table(names.numbers)), names.active_bitmaps, first, last)


def _rolling(spark: SparkSession, first: date, last: date, names: TableNames) -> None:
    """Rolling counts of the days from ``first`` to ``last``; a window that reaches back reads bitmaps only."""
    number_users_of(spark, first, last, names)
    found = rolling.rolling_active_users(spark.table(names.active_bitmaps), first, last)
    older = spark.table(names.rolling).where(F.col("event_date") < F.lit(first))
    tables.rebuild_small(older.unionByName(found), names.rolling)


# The step of one new day


def _forget_snapshots(spark: SparkSession, day: date, names: TableNames) -> None:
    """Drop the snapshots and open sessions that include ``day``, as what they were made of is about to change."""
    for table in (names.snapshot, names.open_sessions):
        if not tables.table_missing(spark, table):
            for held in tables.partition_days(spark, table):
                if held >= day:
                    tables.drop_day(spark, table, held)


def step_gold(spark: SparkSession, day: date, names: TableNames = TableNames(), metrics: bool = True) -> bool:
    """Bring the gold and serving tables from the day before to ``day``; False if that needs a rebuild.

    Reads the snapshot of the day before and the activity and events of ``day``. The new snapshot is written
    first and the old one dropped last: where both are there, or none, a load was broken, and the tables are rebuilt.
    """
    if tables.partition_days(spark, names.snapshot) != [day - timedelta(days=1)]:
        return False
    before = tables.day_partition(spark, names.snapshot, day - timedelta(days=1))
    held = before.select("window", "metrics").first()
    if held is None or held["window"] != schemas.DEFAULT_WINDOW or metrics and not held["metrics"]:
        return False
    daily = tables.day_partition(spark, names.activity, day)
    tables.replace_day(snapshot.advance(before, daily, day, metrics=metrics), names.snapshot, day)
    now = tables.day_partition(spark, names.snapshot, day)
    _step_states(spark, now, day, names)
    if metrics:
        _step_metrics(spark, now, daily, day, names)
    tables.drop_day(spark, names.snapshot, day - timedelta(days=1))
    return True


def _step_states(spark: SparkSession, now: DataFrame, day: date, names: TableNames) -> None:
    """Add the ranges that begin on ``day`` and close those that they follow. Only the partitions in which
    ranges end are read and written; there are at most as many as days."""
    starts = now.where("closed_since IS NOT NULL").select(F.date_from_unix_date("closed_since").alias("start_date")).distinct()
    touched = {r["start_date"] for r in starts.collect()}
    at = F.col("start_date").isin([*touched]) if touched else F.lit(False)
    kept = snapshot.close_ranges(spark.table(names.states).where(at), now, day)
    touched.add(day)
    rows = kept.unionByName(snapshot.opened_ranges(now, day))
    tables.replace_where(rows, names.states, F.col("start_date").isin([*touched]), lambda v: date.fromisoformat(v) in touched)


def _step_metrics(spark: SparkSession, now: DataFrame, daily: DataFrame, day: date, names: TableNames) -> None:
    """Add ``day`` to the serving tables. Those of growth, depth and cohorts have a few rows a day."""
    counts = snapshot.day_counts(now, day).first().asDict()
    totals = daily.agg(F.coalesce(F.sum("total_events"), F.lit(0)).alias("events"), F.coalesce(F.sum("miles_earned_sum"), F.lit(0)).cast(schemas.MILES).alias("miles")).first()
    starts = spark.range(1).select(
        *[period_start(F.lit(day), p).alias(p) for p in PERIODS],
        *[period_from_index(period_index(F.lit(day), p) - 1, p).alias(f"{p}_before") for p in PERIODS],
    ).first()

    def held(table: str) -> dict[tuple, dict]:
        """The rows of the running periods and the ones before."""
        rows = spark.table(table).where(F.col("period_start").isin([*starts])).collect()
        return {(r["period"], r["period_start"]): r.asDict() for r in rows}

    grown, depth, old_growth, old_depth = [], [], held(names.growth), held(names.engagement)
    for p in PERIODS:
        start, so_far = starts[p], old_growth.get((p, starts[p]), {})
        new, retained, resurrected = (so_far.get(c, 0) + counts[f"{p}_{c}"] for c in ("new_users", "retained_users", "resurrected_users"))
        active, churned = new + retained + resurrected, old_growth.get((p, starts[f"{p}_before"]), {}).get("active_users", 0) - retained
        if active or churned:
            grown.append((p, start, active, new, retained, resurrected, churned))
        if active:
            so_far = old_depth.get((p, start), {})
            sums = (so_far.get("total_events", 0) + totals["events"], so_far.get("miles_earned", 0) + totals["miles"])
            depth.append((p, start, active, *sums, *(so_far.get(c, 0) + counts[f"{p}_{c}"] for c in ("earners", "redeemers"))))

    def put(rows: DataFrame, table: str) -> None:
        others = spark.table(table).join(rows.select("period", "period_start"), ["period", "period_start"], "left_anti")
        tables.rebuild_small(others.unionByName(rows.select(*others.columns)), table)

    def growing() -> None:
        put(spark.createDataFrame(grown, schemas.GROWTH_ACCOUNTING), names.growth)
        _active_users(spark, names)

    def cohorts() -> None:
        offsets = growth.RETENTION_OFFSETS
        back = spark.createDataFrame([(day - timedelta(days=n), n, counts[f"back_{n}"]) for n in offsets], "cohort_date date, day_offset long, back long")
        share = F.try_divide(F.lit(100.0) * F.col("back"), "cohort_size")
        reached = spark.table(names.cohorts).join(back, ["cohort_date", "day_offset"], "left").select(
            "cohort_date", "cohort_size", "day_offset",
            F.coalesce("back", "retained_users").alias("retained_users"),
            F.coalesce(share, "retention_pct").alias("retention_pct"),
        )
        begun = [(day, counts["new"], n, None, None) for n in offsets if counts["new"]]
        tables.rebuild_small(reached.unionByName(spark.createDataFrame(begun, schemas.COHORT_RETENTION)), names.cohorts)

    def balances() -> None:
        net = (F.col("miles_earned_sum") - F.col("miles_redeemed_sum")).cast(schemas.MILES)
        paid = daily.select("user_id", "event_date", "miles_earned_sum", "miles_redeemed_sum", net.alias("net_miles"))
        held_now = now.select("user_id", F.col("balance").alias("miles_balance"))
        tables.replace_day(paid.join(held_now, "user_id"), names.balance, day)

    of_depth = T.StructType(schemas.ENGAGEMENT_DEPTH.fields[:7])
    events = tables.day_partition(spark, names.clean, day)
    _at_once(
        spark,
        [
            growing,
            cohorts,
            balances,
            lambda: put(engagement.with_ratios(spark.createDataFrame(depth, of_depth)), names.engagement),
            lambda: tables.replace_day(activity.active_users_by_source(events), names.sources, day),
            lambda: _step_sessions(spark, events, day, names),
            lambda: _rolling(spark, day, day, names),
        ],
    )


def _first_day(spark: SparkSession, names: TableNames) -> date | None:
    return next(iter(tables.partition_days(spark, names.activity)), None)


def _rebuild_sessions(spark: SparkSession, first: date, last: date, names: TableNames) -> None:
    """Session counts of the periods that ``first`` to ``last`` touch.

    A session that goes on from the day before such a period counts where it started, so that day is
    read as well.
    """
    edge = spark.range(1).select(
        period_start(F.lit(first), SESSION_PERIOD).alias("low"), period_start(F.lit(last), SESSION_PERIOD).alias("high")
    ).first()
    after = edge["high"] + timedelta(days=6 if SESSION_PERIOD == "week" else 31)
    events = _days(spark, names.clean, edge["low"] - timedelta(days=1), after)
    found = engagement.session_frequency(events, SESSION_PERIOD)
    tables.replace_where(
        found,
        names.sessions,
        F.col("period_start").between(F.lit(edge["low"]), F.lit(edge["high"])),
        lambda v: edge["low"] <= date.fromisoformat(v) <= edge["high"],
    )
    last_events = tables.day_partition(spark, names.clean, last)
    tables.replace_day(engagement.open_sessions(last_events, last), names.open_sessions, last)


def _step_sessions(spark: SparkSession, events: DataFrame, day: date, names: TableNames) -> None:
    """Add the sessions of ``day`` to its period, from its events and the sessions that were open at midnight."""
    before = day - timedelta(days=1)
    still_open = tables.day_partition(spark, names.open_sessions, before)
    if before not in tables.partition_days(spark, names.open_sessions):
        # nobody's, or written before there was such a table: the last gap of the day before tells
        still_open = engagement.open_sessions(tables.day_partition(spark, names.clean, before), before)
    found = engagement.day_sessions(events, still_open, day, SESSION_PERIOD)
    start = spark.range(1).select(period_start(F.lit(day), SESSION_PERIOD).alias("start")).first()["start"]
    held = tables.day_partition(spark, names.sessions, start, "period_start")
    of_period = F.col("period_start") == F.lit(start)
    tables.replace_where(engagement.merged_sessions(held.select(*found.columns), found), names.sessions, of_period, lambda v: v == str(start))
    tables.replace_day(engagement.open_sessions(events, day), names.open_sessions, day)
    tables.drop_day(spark, names.open_sessions, before)


def _range_end(spark: SparkSession, first: date, last: date, names: TableNames) -> date:
    """The day up to which a load of ``first`` to ``last`` rebuilds; refuses to leave a gap."""
    built = built_days(spark, names)
    if not built:
        return last
    if first - timedelta(days=1) > built[-1]:
        raise MissingDay(f"{names.bitmaps} ends on {built[-1]}; {built[-1] + timedelta(days=1)} is missing")
    if last + timedelta(days=1) < built[0]:
        raise MissingDay(f"{names.bitmaps} starts on {built[0]}; {built[0] - timedelta(days=1)} is missing")
    return max(last, built[-1])


def _stop_if_bad(checks: DataFrame, what: str) -> None:
    bad = {r["check"]: r["n_bad"] for r in checks.where("n_bad > 0").collect() if r["check"] not in REPORTED_ONLY}
    if bad:
        raise FailedChecks(f"{what}: {bad}")


def _derive(
    spark: SparkSession, first: date, last: date, names: TableNames, strict: bool, metrics: bool, stored: bool
) -> None:
    """Everything that follows from the bronze events of ``first`` to ``last``."""
    end = _range_end(spark, first, last, names)
    if not stored:
        clean_days(spark, first, last, names)
        _blocks_only(spark, first, last, names)
    elif first == last:
        bitmaps_and_later(spark, first, names)
    else:
        clean_days(spark, first, last, names)
        step_blocks(spark, first, last, names)
        rebuild_bitmaps(spark, first, end, names, last)
    step_activity_days(spark, first, last, names)
    if strict:
        _stop_if_bad(check_bitmaps(spark, first, names, last), f"bitmaps of {first} to {last}")
    if first == end and step_gold(spark, end, names, metrics):
        return
    rebuild_states(spark, end, names)
    if metrics:
        rebuild_metrics(spark, end, names, first)
    daily = spark.table(names.activity)
    tables.replace_day(snapshot.user_snapshot(daily, end, metrics=metrics), names.snapshot, end)


def run_day(
    spark: SparkSession,
    raw_path: str,
    day: date,
    names: TableNames = TableNames(),
    strict: bool = True,
    metrics: bool = True,
    stored: bool = True,
) -> dict[str, int]:
    """Load a day and everything that follows from it; returns the rows of each partition.

    A day before the latest one also rebuilds the days after it. With ``strict``, events that break their
    contract stop the load after bronze, and wrong bitmaps stop it before gold. Without ``stored``, login histories
    are kept in blocks only (:mod:`login_blocks`), and bitmaps are made from them when they are asked for.
    """
    create_tables(spark, names)
    _range_end(spark, day, day, names)
    counts = {"events": load_bronze(spark, raw_path, day, names)}
    if strict:
        _stop_if_bad(check_bronze(spark, raw_path, day, names), f"events of {day}")
    _derive(spark, day, day, names, strict, metrics, stored)
    for key, table in (("clean", names.clean), ("bitmaps", names.bitmaps), ("activity", names.activity)):
        counts[key] = tables.partition_row_count(spark, table, day)
    return counts


def backfill(
    spark: SparkSession,
    raw_path: str,
    first: date,
    last: date,
    names: TableNames = TableNames(),
    strict: bool = True,
    metrics: bool = True,
    stored: bool = True,
) -> None:
    """Load many days at once: one pass over the raw log, then one per table.

    Days that are built already and come after ``last`` are rebuilt on the new ones; kept in blocks only, without
    ``stored``, they stay as they are.
    """
    create_tables(spark, names)
    _range_end(spark, first, last, names)
    load_bronze_days(spark, raw_path, first, last, names)
    if strict:
        _stop_if_bad(check_bronze(spark, raw_path, first, names, last), f"events of {first} to {last}")
    _derive(spark, first, last, names, strict, metrics, stored)


# Publication


def published_root(spark: SparkSession, names: TableNames = TableNames()) -> str:
    return f"{tables.location_of(spark, names.growth).rpartition('/')[0]}/_published"


def settled(spark: SparkSession, names: TableNames = TableNames()) -> bool:
    """Whether all tables are of the same days: no load is running, was broken off, or left out the serving tables.

    A load takes its days out of the ledger when it begins, and drops the snapshot, or holds two, until all tables are written."""
    built = built_days(spark, names)
    if not built or tables.partition_days(spark, names.snapshot) != [built[-1]]:
        return False
    whole = len(built) == (built[-1] - built[0]).days + 1 and {*tables.partition_days(spark, names.events)} <= {*built}
    held = tables.day_partition(spark, names.snapshot, built[-1]).select("metrics").first()
    return whole and bool(held["metrics"])


def publish(spark: SparkSession, names: TableNames = TableNames()) -> published.Version:
    """Show readers all tables as they are now, at once; refused in the middle of a load."""
    if not settled(spark, names):
        raise Unsettled(f"{names.growth} and its neighbours hold a load that isn't complete")
    return published.publish(spark, names.for_readers, published_root(spark, names))


def published_tables(spark: SparkSession, names: TableNames = TableNames()) -> published.Version | None:
    """The current version, to read tables that belong together; it stays the same while the next one is made."""
    return published.current(spark, published_root(spark, names))


def check_bronze(
    spark: SparkSession, raw_path: str, day: date, names: TableNames = TableNames(), last: date | None = None
) -> DataFrame:
    """(check, n_bad) for the loaded days: same row counts as the raw log, no side empty, every raw event
    with a time, and the contract of each event.

    Events without a time belong to no day and never reach the table, so they are counted in the log.
    """
    raw = read_raw(spark, raw_path, day, last, names)
    of_log = raw.agg(
        F.count_if(raw_events.is_on(day, last)).alias("source_rows"),
        F.lit(0).cast("bigint").alias("table_rows"),
        F.count_if(F.col("event_time").isNull()).alias("without_time"),
    )
    table = _days(spark, names.events, day, last or day)
    zero = F.lit(0).cast("bigint")
    loaded = table.agg(zero.alias("source_rows"), F.count(F.lit(1)).alias("table_rows"), zero.alias("without_time"))
    totals = of_log.unionByName(loaded).agg(*(F.sum(c).alias(c) for c in of_log.columns))
    bad = {
        "row_counts_match": F.col("source_rows") != F.col("table_rows"),
        "table_not_empty": F.col("table_rows") == 0,
        "source_not_empty": F.col("source_rows") == 0,
        "event_time_not_null": F.col("without_time"),
    }
    # one scan of the log for all of them
    rows = F.array(*[F.struct(F.lit(k).alias("check"), n.cast("bigint").alias("n_bad")) for k, n in bad.items()])
    contract = quality.event_assertions(table).where("check <> 'event_time_not_null'")
    return totals.select(F.inline(rows)).unionByName(contract)


def check_bitmaps(
    spark: SparkSession, day: date, names: TableNames = TableNames(), last: date | None = None
) -> DataFrame:
    """(check, n_bad) for some days of bitmaps against the devices of their events."""
    return quality.bitmap_checks(
        bitmaps_of_days(spark, day, last or day, names),
        bitmaps.active_devices(_days(spark, names.clean, day, last or day)),
    )


def reconcile_bronze(
    spark: SparkSession, raw_path: str, first: date, last: date, names: TableNames = TableNames()
) -> DataFrame:
    """For each of some days: its rows in the raw log and in bronze, those that bronze lacks, and those that it
    has too many, by content. Days without any row on either side are left out."""
    raw = raw_events.with_event_date(raw_events.day_slice(read_raw(spark, raw_path, first, last, names), first, last))
    return reconcile.day_differences(raw, _days(spark, names.events, first, last), schemas.EVENTS.fieldNames())
