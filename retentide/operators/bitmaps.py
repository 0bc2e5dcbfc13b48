"""Daily login bitmaps: one character per day since a device was first seen.

The grain is one row per device and day. Yesterday's partition and today's devices are both
unique by device, so the daily step is one full outer join without fan-out.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentide.functions.bitmaps import bitmap_of_days, device_id
from retentide.functions.calendar import as_date
from retentide.operators.activity import placed
from retentide.schemas import LOGIN_BITMAPS

COLUMNS = LOGIN_BITMAPS.fieldNames()
# Days that are unfolded together in a backfill.
BLOCK_DAYS = 32
ATTRIBUTES = ("country", "platform", "utm_source", "user_id")


def active_profiles(events: DataFrame) -> DataFrame:
    """Distinct (event_date, country, platform, utm_source, user_id) with activity."""
    return (
        placed(events).select("event_date", *ATTRIBUTES).distinct()
    )


def _earliest() -> Column:
    """The attributes of the first event of a group."""
    return F.min(F.struct("event_time", "country", "utm_source")).alias("earliest")


def active_devices(events: DataFrame) -> DataFrame:
    """One row per day and device, with the country and source of its first event that day."""
    return (
        placed(events)
        .groupBy("event_date", "platform", "user_id")
        .agg(_earliest())
        .select(
            "event_date",
            "earliest.country",
            "platform",
            "earliest.utm_source",
            "user_id",
            device_id(F.col("platform"), F.col("user_id")).alias("device"),
        )
    )


def carry_forward(
    prev: DataFrame, events: DataFrame, day: date | str | Column, key: str = "device"
) -> DataFrame:
    """The bitmaps of ``day`` from those of the day before and the events of ``day``.

    A key seen for the first time starts with '1'; a known one gets a '1' or a '0' appended
    and keeps the attributes it started with.

    ``key="user_id"`` reproduces the login of a whole user instead: every row the user had
    yesterday is repeated once per profile seen today, and new devices of a known user do
    not appear. It is kept for parity; the device key is the one to run.
    """
    events = events.where(F.col("event_date") == as_date(day))
    if key == "device":
        return _carry_devices(prev, active_devices(events), day)
    if key == "user_id":
        return _carry_users(prev, active_profiles(events), day)
    raise ValueError(f"key must be 'device' or 'user_id', not {key!r}")


def _carry_devices(prev: DataFrame, today: DataFrame, day: date | str | Column) -> DataFrame:
    today = today.select(*ATTRIBUTES, "device").withColumn("in_today", F.lit(True)).alias("t")
    prev = (
        prev.select(*ATTRIBUTES, "device", "reg_date", "login_bitmap")
        .withColumn("in_prev", F.lit(True))
        .alias("p")
    )
    both = today.join(prev, F.col("t.device") == F.col("p.device"), "full_outer")
    known, active = F.col("in_prev").isNotNull(), F.col("in_today").isNotNull()
    bit = F.when(active, "1").otherwise("0")
    return both.select(
        as_date(day).alias("event_date"),
        *[F.coalesce(f"p.{c}", f"t.{c}").alias(c) for c in (*ATTRIBUTES, "device")],
        F.when(known, F.concat("login_bitmap", bit)).otherwise("1").alias("login_bitmap"),
        F.when(known, "0").otherwise("1").alias("isNew"),
        F.coalesce("reg_date", as_date(day)).alias("reg_date"),
    ).select(*COLUMNS)


def _carry_users(prev: DataFrame, today: DataFrame, day: date | str | Column) -> DataFrame:
    # Joining the number of today's profiles and repeating rows avoids forming the pairs of
    # yesterday's and today's rows: only the left sides hold more than one row per user, and
    # those are the ones a skewed join can split.
    logins = today.groupBy("user_id").agg(F.count(F.lit(1)).alias("profiles"))
    copies = F.explode(F.sequence(F.lit(1), F.coalesce(F.col("profiles").cast("int"), F.lit(1))))
    known = (
        prev.join(logins, "user_id", "left")
        .withColumn("copy", copies)
        .select(
            as_date(day).alias("event_date"),
            *ATTRIBUTES,
            F.concat(
                "login_bitmap", F.when(F.col("profiles").isNotNull(), "1").otherwise("0")
            ).alias("login_bitmap"),
            F.lit("0").alias("isNew"),
            "reg_date",
            "device",
        )
    )
    fresh = today.join(prev.select("user_id").distinct(), "user_id", "left_anti").select(
        as_date(day).alias("event_date"),
        *ATTRIBUTES,
        F.lit("1").alias("login_bitmap"),
        F.lit("1").alias("isNew"),
        as_date(day).alias("reg_date"),
        device_id(F.col("platform"), F.col("user_id")).alias("device"),
    )
    return known.select(*COLUMNS).unionByName(fresh.select(*COLUMNS))


def device_histories(
    events: DataFrame, as_of: date | str | Column, from_day: date | str | Column | None = None
) -> DataFrame:
    """One row per device with its whole bitmap from the first login up to ``as_of``.

    ``from_day`` leaves out the events before it. A device's set of days has at most one entry per
    calendar day and is combined before the shuffle.
    """
    if from_day is not None:
        events = events.where(F.col("event_date") >= as_date(from_day))
    return (
        events.where(F.col("user_id").isNotNull() & (F.col("event_date") <= as_date(as_of)))
        .groupBy("platform", "user_id")
        .agg(F.sort_array(F.collect_set(F.unix_date("event_date"))).alias("days"), _earliest())
        .withColumn("end", F.unix_date(as_date(as_of)))
        .select(
            "earliest.country",
            "platform",
            "earliest.utm_source",
            "user_id",
            device_id(F.col("platform"), F.col("user_id")).alias("device"),
            F.get("days", F.lit(0)).alias("first"),
            "end",
            bitmap_of_days(F.col("days"), F.col("end")).alias("history"),
        )
    )


def extended_histories(
    prev: DataFrame, events: DataFrame, from_day: date | str | Column, as_of: date | str | Column
) -> DataFrame:
    """The histories up to ``as_of`` from the bitmaps of the day before ``from_day`` and the events since.

    Devices of ``prev`` keep their attributes and get a bit for each new day, others start anew. Only
    the events from ``from_day`` on are read.
    """
    start = F.unix_date(as_date(from_day))
    fresh = device_histories(events, as_of, from_day).select(
        *[F.col(c).alias(f"new_{c}") for c in (*ATTRIBUTES, "first", "history")], "device"
    )
    known = prev.select(*ATTRIBUTES, "device", F.unix_date("reg_date").alias("known_first"), "login_bitmap")
    both = known.join(fresh, "device", "full_outer").withColumn("end", F.unix_date(as_date(as_of)))
    is_known = F.col("known_first").isNotNull()
    idle = F.repeat(F.lit("0"), F.coalesce("new_first", F.col("end") + 1) - start)
    since = F.concat(idle, F.coalesce("new_history", F.lit("")))
    return both.select(
        *[F.when(is_known, F.col(c)).otherwise(F.col(f"new_{c}")).alias(c) for c in ATTRIBUTES],
        "device",
        F.coalesce("known_first", "new_first").alias("first"),
        "end",
        F.when(is_known, F.concat("login_bitmap", since)).otherwise(F.col("new_history")).alias("history"),
    )


def build_bitmaps(
    events: DataFrame,
    as_of: date | str | Column,
    from_day: date | str | Column | None = None,
    buckets: int | None = None,
    prev: DataFrame | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """What running :func:`carry_forward` on every day up to ``as_of`` adds up to.

    Needs one pass over the events instead of one job per day. ``from_day`` leaves out the
    partitions before it, not the history inside the later ones: that comes from all events or,
    with ``prev``, from the bitmaps of the day before.

    The result is far larger than the histories it comes from, a row and a string per device
    and day, so the rows are placed before they are unfolded: blocks of BLOCK_DAYS days of a device
    are dealt out to ``tasks`` tasks (as many as a shuffle has, if not given), and a task then writes
    only the days of its blocks. With ``buckets``, for a table bucketed by device, the histories go to
    their bucket instead.
    """
    if prev is None:
        histories = device_histories(events, as_of)
    else:
        histories = extended_histories(prev, events, from_day, as_of)
    return unfolded(histories, from_day, buckets, tasks)


def unfolded(
    histories: DataFrame, from_day: date | str | Column | None = None, buckets: int | None = None, tasks: int | None = None
) -> DataFrame:
    """The bitmaps of each day up to the ends of histories, in rows placed as :func:`build_bitmaps` says."""
    start = F.col("first")
    if from_day is not None:
        start = F.greatest(start, F.unix_date(as_date(from_day)))
    first, end, block, day = F.col("first"), F.col("end"), F.col("block"), F.col("day")
    histories = histories.withColumn("start", start).where("start <= end")
    if buckets:
        placed = histories.repartition(buckets, "device")
        days = F.sequence("start", "end")
    else:
        opening = block * BLOCK_DAYS
        closing = F.least(end, opening + (BLOCK_DAYS - 1))
        tasks = tasks or int(histories.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        placed = (
            histories.withColumn("block", F.explode(F.sequence(_block("start"), _block("end"))))
            .withColumn("history", F.substring("history", F.lit(1), closing - first + 1))
            .repartitionById(tasks, F.pmod(F.hash("block", "device"), F.lit(tasks)))
        )
        days = F.sequence(F.greatest("start", opening), closing)
    return (
        placed.withColumn("day", F.explode(days))
        .withColumn("age", day - first + 1)
        .select(
            F.date_from_unix_date(day).alias("event_date"),
            *ATTRIBUTES,
            F.substring("history", F.lit(1), F.col("age")).alias("login_bitmap"),
            F.when(F.col("age") == 1, "1").otherwise("0").alias("isNew"),
            F.date_from_unix_date(first).alias("reg_date"),
            "device",
        )
        .select(*COLUMNS)
    )


def _block(day: str) -> Column:
    return F.floor(F.col(day) / BLOCK_DAYS).cast("int")


def activity_of(bitmaps: DataFrame) -> DataFrame:
    """(user_id, event_date) for every '1' of the bitmaps, duplicates across devices kept.

    One day's partition holds the whole history of every device seen so far, so its rows are
    enough to rebuild all user states.
    """
    return (
        bitmaps.where(F.col("user_id").isNotNull())
        .select("user_id", "reg_date", F.posexplode(F.split("login_bitmap", "")))
        .where(F.col("col") == "1")
        .select("user_id", F.date_add("reg_date", F.col("pos")).alias("event_date"))
    )
