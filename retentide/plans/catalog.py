"""The registered queries: every operator over the whole sample tables.

Those named ``table_*`` and ``job_*`` run the table layer and the daily batch themselves, on tables of
their own below the session's warehouse.

Each takes (spark, sf_dir) and returns a DataFrame with every computed column named.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import timedelta
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retentide.functions import bitmaps as bits
from retentide.functions.calendar import (
    last_day_of,
    parse_day,
    period_from_index,
    period_index,
    period_start,
)
from retentide.operators import activity, bitmaps, cleaning, engagement, growth, login_blocks, quality, reconcile, rolling, states
from retentide.schemas import (
    BRONZE_EVENTS,
    CLEAN_EVENTS,
    DEVICE_PATTERN,
    EVENTS,
    LOGIN_BLOCKS,
    MILES,
    SESSION_FREQUENCY,
    USER_DAILY_ACTIVITY,
    USER_MILES_BALANCE,
)
from retentide.plans import jobs
from retentide.session import shared_path
from retentide.sources import published, quoted_lines, raw_events, tables
from retentide.sources.sample_tables import (
    loyalty_events,
    order_events,
    read_table,
)

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
# The window of the queries on the sample events, which reach all four states with it.
WINDOW = 2


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


# Bronze


@query
def bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loyalty_events(spark, sf_dir).select(*EVENTS.fieldNames(), "event_date")


def _odd_categories(events: DataFrame) -> DataFrame:
    """Categories with everything that CSV has to quote: quotes, commas, backslashes, blanks at the ends."""
    k, category = F.col("event_id") % 6, F.coalesce("transaction_category", F.lit(""))
    odd = (
        F.when(k == 0, F.concat(F.lit('Joe "X" '), category))
        .when(k == 1, F.concat(F.lit("C:\\dir"), category, F.lit('"')))
        .when(k == 2, F.concat(F.lit('Bob "Y", '), category))
        .when(k == 3, F.concat(F.lit("  "), category, F.lit(" x ")))
        .when(k == 4, F.concat(F.lit('"'), category, F.lit('\\"')))
        .otherwise(F.col("transaction_category"))
    )
    return events.withColumn("transaction_category", odd)


@lru_cache(maxsize=None)
def _raw_log(spark: SparkSession, sf_dir: str) -> str:
    """The sample events, with odd categories, as a raw CSV log in the shared folder."""
    path = shared_path(spark, "raw-events")
    raw_events.write_raw_events(_odd_categories(loyalty_events(spark, sf_dir)), path)
    return path


@query
def bronze_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_events.with_event_date(raw_events.read_raw_events(spark, _raw_log(spark, sf_dir)))


@query
def bronze_csv_two_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_events.read_raw_events(spark, _raw_log(spark, sf_dir))
    return raw.groupBy("platform", "country").agg(F.count(F.lit(1)).alias("n"))


@query
def bronze_quoted_line_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw log with line breaks inside quoted values: at their ends, several in a row, beside quotes."""
    events = loyalty_events(spark, sf_dir)
    k, category = F.col("event_id") % 5, F.coalesce("transaction_category", F.lit("none"))
    broken = (
        F.when(k == 0, F.concat(category, F.lit("\n")))
        .when(k == 1, F.concat(F.lit('\n\n"'), category))
        .when(k == 2, F.concat(category, F.lit(',\n"x"\n,,,')))
        .otherwise(F.col("transaction_category"))
    )
    path = shared_path(spark, "quoted-lines")
    raw_events.write_raw_events(events.withColumn("transaction_category", broken), path)
    return raw_events.with_event_date(quoted_lines.read_quoted_lines(spark, path))


def _bounds(spark: SparkSession, sf_dir: str):
    """First and last day of the sample events."""
    days = loyalty_events(spark, sf_dir).agg(F.min("event_date").alias("low"), F.max("event_date").alias("high")).first()
    return days["low"], days["high"]


@query
def bronze_day_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, last = _bounds(spark, sf_dir)
    return raw_events.day_slice(loyalty_events(spark, sf_dir), last).select(*EVENTS.fieldNames())


@query
def calendar_has_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = order_events(spark, sf_dir)
    first = orders.agg(F.min("event_date").alias("first_day")).scalar()
    return quality.calendar_counts(orders, first, last_day_of(orders)).select(
        "event_date", (F.col("row_count") > 0).alias("has_rows")
    )


@query
def calendar_day_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.day_counts(loyalty_events(spark, sf_dir))


# The table layer and the daily batch


def _fresh_names() -> jobs.TableNames:
    return jobs.TableNames.prefixed(f"q{uuid.uuid4().hex[:10]}")


@lru_cache(maxsize=None)
def _warehouse(spark: SparkSession, sf_dir: str) -> jobs.TableNames:
    """Tables built by the batch: the first days by a backfill, the last one by the daily run, and then a
    day in the middle once more."""
    names, raw = _fresh_names(), _raw_log(spark, sf_dir)
    first, last = _bounds(spark, sf_dir)
    # the sample may break the contract of events, which a query of its own counts
    jobs.backfill(spark, raw, first, last - timedelta(days=1), names, strict=False)
    jobs.run_day(spark, raw, last, names, strict=False)
    jobs.run_day(spark, raw, first + (last - first) // 2, names, strict=False)
    return names


@query
def table_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the probes say before and after the table is made, loaded and loaded again."""
    names, raw = _fresh_names(), _raw_log(spark, sf_dir)
    _, last = _bounds(spark, sf_dir)
    missing = tables.table_missing(spark, names.events)
    created = tables.create_day_table(spark, names.events, BRONZE_EVENTS, "event_date")
    again = tables.create_day_table(spark, names.events, BRONZE_EVENTS, "event_date")
    before = tables.partition_exists(spark, names.events, last)
    first_load, second_load = (jobs.load_bronze(spark, raw, last, names) for _ in range(2))
    row = (missing, created, again, before, first_load, second_load, tables.partition_exists(spark, names.events, last), tables.partition_row_count(spark, names.events, last))
    columns = "missing boolean, created boolean, created_again boolean, had_rows boolean, loaded long, loaded_again long, has_rows boolean, n_rows long"
    return spark.createDataFrame([row], columns)


@query
def table_day_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, last = _bounds(spark, sf_dir)
    return tables.day_partition(spark, _warehouse(spark, sf_dir).events, last).select(*EVENTS.fieldNames(), "event_date")


@query
def table_history_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = spark.table(_warehouse(spark, sf_dir).bitmaps)
    return silver.groupBy("event_date").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.length("login_bitmap")).alias("n_bits"))


@query
def table_replaced_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table whose second half of days is replaced by other rows and whose last day becomes empty."""
    names, events = _fresh_names(), loyalty_events(spark, sf_dir).select(*EVENTS.fieldNames(), "event_date")
    first, last = _bounds(spark, sf_dir)
    middle = first + (last - first) // 2
    tables.create_day_table(spark, names.events, BRONZE_EVENTS, "event_date")
    tables.replace_days(events, names.events, first, last)
    changed = events.where(F.col("event_date") < F.lit(last)).withColumn("utm_source", F.lit("changed"))
    tables.replace_days(changed, names.events, middle, last)
    return spark.table(names.events).groupBy("event_date", "utm_source").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def table_rebuilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that is rebuilt with fewer partitions than it had."""
    names = _fresh_names()
    daily = activity.user_daily_activity(loyalty_events(spark, sf_dir))
    tables.create_day_table(spark, names.activity, USER_DAILY_ACTIVITY, "event_date")
    tables.rebuild(daily, names.activity)
    first, last = _bounds(spark, sf_dir)
    tables.rebuild(daily.where(F.col("event_date") > F.lit(first + (last - first) // 2)), names.activity)
    return spark.table(names.activity).groupBy("event_date").agg(F.count(F.lit(1)).alias("n_users"))


@query
def job_bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(_warehouse(spark, sf_dir).events).select(*EVENTS.fieldNames(), "event_date")


@query
def job_day_arguments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each loaded day as the command line takes it, with the day before, whose bitmaps its load reads."""
    days = jobs.built_days(spark, _warehouse(spark, sf_dir))
    texts = [f"{d:%Y%m%d}" for d in days]
    rows = [(t, parse_day(t), parse_day(t) - timedelta(days=1)) for t in texts]
    return spark.createDataFrame(rows, "argument string, day date, day_before date")


@query
def job_login_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(_warehouse(spark, sf_dir).bitmaps).select(*bitmaps.COLUMNS)


@lru_cache(maxsize=None)
def _blocks_warehouse(spark: SparkSession, sf_dir: str) -> jobs.TableNames:
    """Tables of the batch that keep login histories in blocks only: a late backfill, two daily runs, a day once more."""
    names, raw = _fresh_names(), _raw_log(spark, sf_dir)
    first, last = _bounds(spark, sf_dir)
    middle = first + (last - first) // 2
    for low, high in ((middle, last - timedelta(days=1)), (first, middle - timedelta(days=1)), (last, last), (middle, middle)):
        if low <= high:
            jobs.backfill(spark, raw, low, high, names, strict=False, metrics=False, stored=False)
    return names


@query
def job_login_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(_blocks_warehouse(spark, sf_dir).blocks).select(*LOGIN_BLOCKS.fieldNames())


@query
def job_bitmaps_of_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bitmaps of all days, of which none is stored."""
    first, last = _bounds(spark, sf_dir)
    return jobs.bitmaps_of_days(spark, first, last, _blocks_warehouse(spark, sf_dir))


@query
def job_user_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(_warehouse(spark, sf_dir).states).select("user_id", "user_state", "start_date", "end_date")


@query
def job_miles_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_doubles(spark.table(_warehouse(spark, sf_dir).balance)).select(*USER_MILES_BALANCE.fieldNames())


@lru_cache(maxsize=None)
def _stepped(spark: SparkSession, sf_dir: str) -> jobs.TableNames:
    """Tables of which the batch has built the last five days one by one, each from the snapshot of the day before."""
    names, raw = _fresh_names(), _raw_log(spark, sf_dir)
    first, last = _bounds(spark, sf_dir)
    start = max(first, last - timedelta(days=5))
    jobs.backfill(spark, raw, first, start, names, strict=False)
    for n in range((last - start).days):
        jobs.run_day(spark, raw, start + timedelta(days=n + 1), names, strict=False)
    return names


@lru_cache(maxsize=None)
def _published(spark: SparkSession, sf_dir: str) -> tuple[published.Version, published.Version]:
    """Two versions: before and after the last day was loaded."""
    names, raw = _fresh_names(), _raw_log(spark, sf_dir)
    first, last = _bounds(spark, sf_dir)
    jobs.backfill(spark, raw, first, last - timedelta(days=1), names, strict=False)
    before = jobs.publish(spark, names)
    jobs.run_day(spark, raw, last, names, strict=False)
    return before, jobs.publish(spark, names)


def _of_version(version: published.Version, table: str) -> DataFrame:
    """A table of a version, by the last part of its name."""
    return version.table(next(t for t in version.tables if t.endswith(f".{table}")))


@query
def job_published_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _of_version(_published(spark, sf_dir)[1], "fct_daily_user_login_bitmap").select(*bitmaps.COLUMNS)


@query
def job_published_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State ranges of the version before the last day, read after that day was loaded and published."""
    held = _of_version(_published(spark, sf_dir)[0], "scd2_user_state")
    return held.select("user_id", "user_state", "start_date", "end_date")


@query
def job_published_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Growth of both versions."""
    before, now = (_of_version(v, "dws_growth_accounting") for v in _published(spark, sf_dir))
    return before.withColumn("version", F.lit("before")).unionByName(now.withColumn("version", F.lit("now")))


@query
def job_load_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger, and whether bronze still is what it says."""
    names = _warehouse(spark, sf_dir)
    first, last = _bounds(spark, sf_dir)
    now = jobs.ledger_rows(spark, first, last, names).select("event_date", F.col("fingerprint").alias("now"))
    held = spark.table(names.ledger).join(now, "event_date", "left")
    return held.select("event_date", "n_events", "n_clean", F.col("fingerprint").eqNullSafe(F.col("now")).alias("unchanged"))


@query
def job_user_states_stepped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(_stepped(spark, sf_dir).states).select("user_id", "user_state", "start_date", "end_date")


@query
def job_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(_warehouse(spark, sf_dir).growth)


@query
def job_growth_stepped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(_stepped(spark, sf_dir).growth)


@query
def job_cohort_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(_stepped(spark, sf_dir).cohorts).withColumn("retention_pct", F.round("retention_pct", 4))


@query
def job_engagement_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    depth = spark.table(_stepped(spark, sf_dir).engagement).withColumn("miles_earned", F.col("miles_earned").cast("double"))
    return depth.withColumns({c: F.round(c, 4) for c in ("events_per_user", "miles_per_user", "redemption_rate")})


@query
def job_active_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(_stepped(spark, sf_dir).active_users)


@query
def job_miles_balance_stepped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_doubles(spark.table(_stepped(spark, sf_dir).balance)).select(*USER_MILES_BALANCE.fieldNames())


@query
def job_rolling_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(_stepped(spark, sf_dir).rolling)


@query
def job_events_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(_warehouse(spark, sf_dir).clean).select(*CLEAN_EVENTS.fieldNames())


@query
def job_daily_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_doubles(spark.table(_warehouse(spark, sf_dir).activity)).select(*USER_DAILY_ACTIVITY.fieldNames())


@query
def rolling_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct users of 7 and 28 days up to every day of the years of ``orders``."""
    orders = order_events(spark, sf_dir)
    first, last = orders.agg(F.min("event_date"), F.max("event_date")).first()
    nobody = spark.createDataFrame([], "user_id string, user_no long")
    return rolling.rolling_active_users(rolling.daily_bitmaps(orders, rolling.number_users(nobody, orders)), first, last)


@query
def job_active_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(_warehouse(spark, sf_dir).sources).select("event_date", "utm_source", "active_users")


@query
def job_session_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    sessions = spark.table(_warehouse(spark, sf_dir).sessions).select(*SESSION_FREQUENCY.fieldNames())
    return sessions.withColumn("sessions_per_active_day", F.round("sessions_per_active_day", 4))


@query
def job_session_frequency_stepped(spark: SparkSession, sf_dir: str) -> DataFrame:
    sessions = spark.table(_stepped(spark, sf_dir).sessions).select(*SESSION_FREQUENCY.fieldNames())
    return sessions.withColumn("sessions_per_active_day", F.round("sessions_per_active_day", 4))


@query
def job_open_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who may go on after the last day's midnight, as the last daily step left it."""
    return spark.table(_stepped(spark, sf_dir).open_sessions)


@query
def job_indexed_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last day of a log without folders of days, from the files that the log's index names."""
    _, last = _bounds(spark, sf_dir)
    path = shared_path(spark, "raw-files")
    raw_events.write_raw_events(_odd_categories(loyalty_events(spark, sf_dir)).repartitionByRange(16, "event_time"), path)
    return raw_events.day_slice(jobs.read_raw(spark, path, last, names=_warehouse(spark, sf_dir)), last)


@query
def job_reconcile_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw log against the bronze table that the batch has built from it."""
    first, last = _bounds(spark, sf_dir)
    return jobs.reconcile_bronze(spark, _raw_log(spark, sf_dir), first, last, _warehouse(spark, sf_dir))


@query
def job_check_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, last = _bounds(spark, sf_dir)
    return jobs.check_bronze(spark, _raw_log(spark, sf_dir), first, _warehouse(spark, sf_dir), last)


@query
def job_check_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, last = _bounds(spark, sf_dir)
    return jobs.check_bitmaps(spark, first, _warehouse(spark, sf_dir), last)


@query
def bronze_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Timestamps cut to the hour make many rows share an event key.
    events = loyalty_events(spark, sf_dir).select(*EVENTS.fieldNames(), "event_date")
    return cleaning.dedup(events.withColumn("event_time", F.date_trunc("hour", "event_time")))


@query
def bronze_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean(loyalty_events(spark, sf_dir).select(*EVENTS.fieldNames(), "event_date"))


# Silver


@query
def silver_active_today(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitmaps.active_profiles(loyalty_events(spark, sf_dir))


@query
def silver_login_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = loyalty_events(spark, sf_dir)
    return bitmaps.build_bitmaps(events, last_day_of(events))


def _step(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    events = loyalty_events(spark, sf_dir)
    day = last_day_of(events)
    yesterday = F.date_sub(day, 1)
    prev = bitmaps.build_bitmaps(events, yesterday, from_day=yesterday)
    return bitmaps.carry_forward(prev, events, day, key)


@query
def silver_step_device_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _step(spark, sf_dir, "device")


@query
def silver_step_user_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _step(spark, sf_dir, "user_id")


@query
def bitmap_to_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_login_bitmap(spark, sf_dir).select(
        "event_date", "device", bits.bitmap_to_words(F.col("login_bitmap")).alias("words")
    ).select("event_date", "device", F.posexplode("words").alias("place", "bits"))


def _order_logins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_events(spark, sf_dir).select(
        "*",
        F.col("event_date").cast("timestamp").alias("event_time"),
        *[F.lit(v).alias(c) for c, v in [("platform", "web"), ("country", "SG"), ("utm_source", "")]],
    )


def _order_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bitmaps of ``orders`` on their last day: histories of years, in one row a user."""
    orders = _order_logins(spark, sf_dir)
    last = last_day_of(orders)
    return bitmaps.build_bitmaps(orders, last, from_day=last)


@query
def bitmap_to_words_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = bits.bitmap_to_words(F.col("login_bitmap")).alias("words")
    return _order_bitmaps(spark, sf_dir).select("user_id", words).select("user_id", F.posexplode("words").alias("place", "bits"))


@query
def silver_login_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of histories of years."""
    return login_blocks.login_blocks(_order_logins(spark, sf_dir)).select("user_id", "block", "days")


@query
def silver_bitmaps_of_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the bitmaps that come from the blocks, on the last day."""
    orders = _order_logins(spark, sf_dir)
    last = last_day_of(orders)
    words = bits.bitmap_to_words(F.col("login_bitmap")).alias("words")
    found = login_blocks.bitmaps_of(login_blocks.login_blocks(orders), last, last)
    return found.select("user_id", words).select("user_id", F.posexplode("words").alias("place", "bits"))


@query
def silver_block_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active days of the last two quarters, counted in the blocks that they touch."""
    orders = _order_logins(spark, sf_dir)
    return login_blocks.window_counts(login_blocks.login_blocks(orders), last_day_of(orders), 90)


def _as_doubles(df: DataFrame) -> DataFrame:
    """Miles as doubles, as the SQL of the tests has them."""
    return df.withColumns({f.name: F.col(f.name).cast("double") for f in df.schema if f.dataType == MILES})


@query
def user_daily_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_doubles(activity.user_daily_activity(loyalty_events(spark, sf_dir)))


@query
def user_miles_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = activity.user_daily_activity(loyalty_events(spark, sf_dir))
    return _as_doubles(activity.user_miles_balance(daily))


# Gold: state ranges


def _ranges(events: DataFrame, window: int) -> DataFrame:
    return states.user_states(events, last_day_of(events), window)


@query
def gold_scd2_user_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranges(loyalty_events(spark, sf_dir), WINDOW)


@query
def gold_scd2_short_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranges(loyalty_events(spark, sf_dir), 1)


@query
def gold_scd2_all_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranges(loyalty_events(spark, sf_dir), 3)


@query
def gold_scd2_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranges(order_events(spark, sf_dir), 14)


@query
def gold_scd2_orders_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranges(order_events(spark, sf_dir), 90)


@query
def gold_scd2_from_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return states.user_states_from_bitmaps(silver_login_bitmap(spark, sf_dir), WINDOW)


@query
def gold_scd2_from_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = order_events(spark, sf_dir)
    counts = states.window_counts(events, last_day_of(events), 14)
    return states.close_ranges(states.segments(states.islands(states.classify(counts, 14))))


@query
def gold_activity_streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = order_events(spark, sf_dir)
    streaks = states.activity_streaks(events, last_day_of(events), 90)
    return streaks.select(
        "user_id",
        *[F.date_from_unix_date(c).alias(c) for c in ("first", "last", "prev_last", "next_first")],
    )


@query
def gold_uid_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return states.user_epochs(silver_login_bitmap(spark, sf_dir))


@query
def gold_uid_epoch_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return states.with_user_epoch(silver_login_bitmap(spark, sf_dir)).select(
        "user_id", "device", "event_date", "reg_date", "uid_reg_date", "login_bitmap"
    )


@query
def gold_uid_daily_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = states.user_daily_bits(silver_login_bitmap(spark, sf_dir))
    return daily.select("user_id", "event_date", "uid_reg_date", F.posexplode("uid_bits").alias("place", "bits"))


@query
def gold_uid_daily_bits_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = states.user_daily_bits(_order_bitmaps(spark, sf_dir))
    return daily.select("user_id", "event_date", "uid_reg_date", F.posexplode("uid_bits").alias("place", "bits"))


@query
def gold_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return states.counts_from_bits(states.user_daily_bits(silver_login_bitmap(spark, sf_dir)), WINDOW)


@query
def gold_window_counts_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = order_events(spark, sf_dir)
    return states.window_counts(events, last_day_of(events), 90)


@query
def gold_user_state_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return states.classify(gold_window_counts(spark, sf_dir), WINDOW)


@query
def gold_state_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return states.state_changes(gold_user_state_daily(spark, sf_dir))


@query
def gold_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return states.islands(gold_user_state_daily(spark, sf_dir))


@query
def gold_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return states.segments(gold_islands(spark, sf_dir))


# Gold: serving metrics


def _growth(events: DataFrame, period: str) -> DataFrame:
    return growth.growth_accounting(events, period, last_day_of(events))


@query
def growth_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _growth(loyalty_events(spark, sf_dir), "day")


@query
def growth_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _growth(order_events(spark, sf_dir), "week")


@query
def growth_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _growth(order_events(spark, sf_dir), "month")


def _retention(events: DataFrame) -> DataFrame:
    cohorts = growth.cohort_retention(events, last_day_of(events))
    return cohorts.withColumn("retention_pct", F.round("retention_pct", 4))


@query
def cohort_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _retention(order_events(spark, sf_dir))


@query
def cohort_retention_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _retention(loyalty_events(spark, sf_dir))


def _depth(spark: SparkSession, sf_dir: str, period: str) -> DataFrame:
    daily = activity.user_daily_activity(loyalty_events(spark, sf_dir))
    depth = _as_doubles(engagement.engagement_depth(daily, period))
    rounded = {"events_per_user": 4, "miles_per_user": 4, "redemption_rate": 4}
    return depth.withColumns({c: F.round(c, n) for c, n in rounded.items()})


@query
def engagement_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _depth(spark, sf_dir, "day")


@query
def engagement_depth_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _depth(spark, sf_dir, "week")


@query
def engagement_depth_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _depth(spark, sf_dir, "month")


@query
def session_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    sessions = engagement.session_frequency(loyalty_events(spark, sf_dir), "week")
    return sessions.withColumn(
        "sessions_per_active_day", F.round("sessions_per_active_day", 4)
    )


@query
def dau(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.active_users(loyalty_events(spark, sf_dir), "day")


@query
def wau(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.active_users(loyalty_events(spark, sf_dir), "week")


@query
def mau(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.active_users(order_events(spark, sf_dir), "month")


@query
def new_users_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.new_users(order_events(spark, sf_dir), "day")


@query
def active_by_utm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.active_users_by_source(loyalty_events(spark, sf_dir))


# Data quality. The checks read every row of tables with damaged columns, so that they find something.


def _damaged_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bitmaps with a wrong last bit, a wrong isNew or another device for some users."""
    table, tail = silver_login_bitmap(spark, sf_dir), F.right("user_id", F.lit(1))
    bitmap = F.col("login_bitmap")
    flipped = F.concat(F.left(bitmap, F.length(bitmap) - 1), F.when(bitmap.endswith("1"), "0").otherwise("1"))
    return table.withColumns(
        {
            "login_bitmap": F.when(tail == "3", flipped).otherwise(bitmap),
            "isNew": F.when((tail == "5") & bitmap.endswith("0"), "1").otherwise(F.col("isNew")),
            "device": F.when(tail == "7", F.concat("device", F.lit("x"))).otherwise(F.col("device")),
        }
    )


def _feeds(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return _damaged_bitmaps(spark, sf_dir), bitmaps.active_devices(loyalty_events(spark, sf_dir))


@query
def dq_bronze_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = loyalty_events(spark, sf_dir)
    # rows that were loaded into the day after
    moved = F.when(F.col("event_id") % 50 == 0, F.date_add("event_date", 1)).otherwise(F.col("event_date"))
    return quality.row_count_differences(events, events.withColumn("event_date", moved))


def _damaged_copy(events: DataFrame) -> DataFrame:
    """A copy that lost rows, has others twice, and in which values were swapped, emptied or put on another day."""
    k = F.col("event_id")
    copies = F.when(k % 211 == 0, 0).when(k % 89 == 0, 2).otherwise(1)
    return events.where(copies > 0).withColumns(
        {
            "country": F.when(k % 97 == 0, "SG").otherwise(F.col("country")),
            "miles_amount": F.when(k % 61 != 0, F.col("miles_amount")),
            "event_date": F.when(k % 131 == 0, F.date_add("event_date", 1)).otherwise(F.col("event_date")),
            "copy": F.explode(F.sequence(F.lit(1), copies)),
        }
    )


@query
def dq_reconcile_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows by which a damaged copy differs, found through fingerprints."""
    events = loyalty_events(spark, sf_dir)
    return reconcile.row_differences(events, _damaged_copy(events), EVENTS.fieldNames())


@query
def dq_reconcile_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = loyalty_events(spark, sf_dir)
    return reconcile.day_differences(events, _damaged_copy(events), EVENTS.fieldNames())


@query
def dq_bronze_not_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = order_events(spark, sf_dir)
    first = orders.agg(F.min("event_date").alias("first_day")).scalar()
    return quality.empty_days(orders, first, last_day_of(orders), "table_not_empty")


@query
def dq_source_not_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = loyalty_events(spark, sf_dir)
    first = events.agg(F.min("event_date").alias("first_day")).scalar()
    return quality.empty_days(events, first, last_day_of(events), "source_not_empty")


@query
def dq_events_assertions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.event_assertions(loyalty_events(spark, sf_dir))


@query
def dq_events_assertions_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = loyalty_events(spark, sf_dir)
    k, amount, kind = F.col("event_id"), F.col("miles_amount"), F.col("event_type")
    damaged = events.select(
        F.when(k % 11 != 0, F.col("event_time")).alias("event_time"),
        F.when(k % 13 == 0, F.regexp_replace("user_id", "u_", "user-"))
        .when(k % 17 != 0, F.col("user_id"))
        .alias("user_id"),
        F.when(k % 19 == 0, "login").otherwise(kind).alias("event_type"),
        F.when(k % 23 == 0, F.lit(0.0))
        .when(k % 29 == 0, F.lit(1.0))
        .when(k % 31 != 0, amount)
        .alias("miles_amount"),
        F.when(k % 37 == 0, "US").otherwise(F.col("country")).alias("country"),
        F.when(k % 41 != 0, F.col("gender")).alias("gender"),
        F.when(k % 43 == 0, "tv").otherwise(F.col("platform")).alias("platform"),
        F.when(k % 47 == 0, "").otherwise(F.col("utm_source")).alias("utm_source"),
    )
    return quality.event_assertions(damaged)


@query
def dq_silver_row_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    is_new = F.col("isNew") == "1"
    damaged = silver_login_bitmap(spark, sf_dir).withColumns(
        {
            "device": F.when(
                is_new & (F.col("platform") == "ios"), F.regexp_replace("device", "_", "")
            ).when(~is_new | (F.col("country") != "SG"), F.col("device")),
            "isNew": F.when(F.col("login_bitmap") == "10", "1").otherwise(F.col("isNew")),
        }
    )
    return quality.bitmap_row_checks(damaged)


@query
def dq_silver_missing_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.missing_devices(*_feeds(spark, sf_dir))


@query
def dq_silver_active_ends_1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.active_without_login(*_feeds(spark, sf_dir))


@query
def dq_silver_inactive_ends_0(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.login_without_activity(*_feeds(spark, sf_dir))


@query
def dq_silver_new_not_in_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.new_without_activity(*_feeds(spark, sf_dir))


@query
def dq_silver_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.bitmap_checks(*_feeds(spark, sf_dir))


# Scalar functions and predicates


@query
def scalar_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders")
    day = F.to_date("o_orderdate")
    return orders.select(
        "o_orderkey",
        day.alias("order_day"),
        F.datediff(day, F.lit("1995-01-01").cast("date")).cast("bigint").alias("days_since"),
        F.date_sub(day, 1).alias("day_before"),
        period_start(day, "week").alias("week_start"),
        period_start(day, "month").alias("month_start"),
        period_from_index(period_index(day, "month") + 1, "month").alias("next_month"),
        period_from_index(period_index(day, "week") + 1, "week").alias("next_week"),
    )


@query
def scalar_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    device = bits.device_id(F.col("platform"), F.col("user_id"))
    category = F.col("transaction_category")
    return loyalty_events(spark, sf_dir).select(
        "event_id",
        device.alias("device"),
        bits.device_id(F.col("platform"), category).alias("device_or_null"),
        F.lpad(category, 5, "0").alias("padded"),
        F.length(device).cast("bigint").alias("device_length"),
        F.right(device, F.lit(3)).alias("tail"),
        F.size(F.filter(F.split(device, ""), lambda c: c == "0")).cast("bigint").alias("zeros"),
        device.rlike(DEVICE_PATTERN).alias("is_device"),
        F.col("user_id").rlike(r"^u_\d{3}7$").alias("matches_pattern"),
        F.startswith(F.col("event_time").cast("string"), F.lit("2024-01-1")).alias("in_second_third"),
        F.endswith(device, F.lit("1")).alias("ends_with_1"),
    )


@query
def scalar_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    return orders.select(
        "o_orderkey",
        F.shiftleft(key, 3).alias("shifted_left"),
        F.shiftright(key, 2).alias("shifted_right"),
        key.bitwiseAND(F.lit(255).cast("bigint")).alias("low_byte"),
        F.bit_count(key).cast("bigint").alias("bits_set"),
        bits.active_days_in(F.array(key), 7).alias("bits_in_low_seven"),
        bits.active_days_in(F.array(key), 7, skip=7).alias("bits_in_next_seven"),
        F.pow(F.lit(2), key % 40).cast("bigint").alias("power"),
    )


@query
def predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount, category = F.col("miles_amount"), F.col("transaction_category")
    return (
        loyalty_events(spark, sf_dir)
        .where((amount > 0) | (F.col("platform") == "web"))
        .where(F.col("user_id").isNotNull() & ~F.col("user_id").rlike("9$"))
        .select(
            "event_id",
            F.when(amount >= 100, "large")
            .when(amount >= 10, "medium")
            .when(amount.isNotNull(), "small")
            .otherwise("none")
            .alias("size"),
            F.when(amount > 50, 1).otherwise(0).cast("bigint").alias("above_50"),
            F.coalesce(category, F.col("platform")).alias("category_or_platform"),
            category.isNull().alias("without_category"),
            (F.col("event_date") == F.lit("2024-01-15").cast("date")).alias("on_the_15th"),
        )
    )
