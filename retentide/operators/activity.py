"""Who was active when: distinct activity, daily user rollups and running balances.

All later stages work on these results, where one user has at most one entry per day. That
bounds what a single user can bring to a task, however many events the user has: the events
of a heavy user are folded on the map side before any row is shuffled. Events without a user or
without a day are left out throughout.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from retentide.functions.calendar import as_date, period_index, period_start
from retentide.schemas import EVENT_TYPES, MILES, USER_DAILY_ACTIVITY


def placed(events: DataFrame) -> DataFrame:
    """Events that have a user and a day."""
    return events.where(F.col("user_id").isNotNull() & F.col("event_date").isNotNull())


def active_periods(events: DataFrame, period: str = "day") -> DataFrame:
    """Distinct (user_id, event_date), ``event_date`` being the first day of the period."""
    return (
        placed(events)
        .select("user_id", period_start(F.col("event_date"), period).alias("event_date"))
        .distinct()
    )


def user_calendars(
    events: DataFrame, as_of: date | str | Column, period: str = "day"
) -> DataFrame:
    """One row per user: the sorted distinct periods with activity up to ``as_of``.

    ``periods`` holds period indexes, day numbers for days: four bytes per active day, and
    never more entries than the calendar has periods. Takes any rows with (user_id,
    event_date), distinct or not, and needs a single shuffle of already combined sets.
    """
    index = period_index(F.col("event_date"), period)
    return (
        events.where(F.col("user_id").isNotNull() & (F.col("event_date") <= as_date(as_of)))
        .groupBy("user_id")
        .agg(F.sort_array(F.collect_set(index)).alias("periods"))
    )


def user_daily_activity(events: DataFrame) -> DataFrame:
    """One row per user and day: event counts by type and the miles that moved, to the cent."""

    def is_type(name: str) -> Column:
        return F.col("event_type") == name

    def miles(name: str) -> Column:
        amount = F.when(is_type(name), F.col("miles_amount").cast("decimal(18,2)"))
        return F.coalesce(F.sum(amount), F.lit(0)).cast(MILES)

    return (
        placed(events)
        .groupBy("event_date", "user_id")
        .agg(
            F.count(F.lit(1)).alias("total_events"),
            miles("miles_earned").alias("miles_earned_sum"),
            miles("miles_redeemed").alias("miles_redeemed_sum"),
            *[F.count_if(is_type(t)).alias(f"cnt_{t}") for t in EVENT_TYPES],
        )
        .withColumn("is_active", F.lit(True))
        .select(*USER_DAILY_ACTIVITY.fieldNames())
    )


def user_miles_balance(daily: DataFrame, from_day: date | str | Column | None = None) -> DataFrame:
    """Running net miles per user over the rows of :func:`user_daily_activity`.

    With ``from_day``, only the rows from then on: the days before are summed up to an opening balance,
    which is combined on the map side, instead of being carried through the window.
    """
    so_far = W.partitionBy("user_id").orderBy("event_date").rowsBetween(W.unboundedPreceding, 0)
    net = (F.col("miles_earned_sum") - F.col("miles_redeemed_sum")).cast(MILES)
    rows = daily.select("user_id", "event_date", "miles_earned_sum", "miles_redeemed_sum", net.alias("net_miles"))
    running = F.sum("net_miles").over(so_far)
    if from_day is not None:
        first = as_date(from_day)
        before = rows.where(F.col("event_date") < first).groupBy("user_id").agg(F.sum("net_miles").alias("opening"))
        rows = rows.where(F.col("event_date") >= first).join(before, "user_id", "left")
        running = running + F.coalesce("opening", F.lit(0))
    return rows.withColumn("miles_balance", running.cast(MILES)).drop("opening")


def active_users(events: DataFrame, period: str = "day") -> DataFrame:
    """Distinct active users per calendar day, week or month."""
    return (
        active_periods(events, period)
        .groupBy(F.col("event_date").alias("period_start"))
        .agg(F.count(F.lit(1)).alias("active_users"))
    )


def new_users(events: DataFrame, period: str = "day") -> DataFrame:
    """Users per period in which they were active for the first time."""
    return (
        placed(events)
        .groupBy("user_id")
        .agg(F.min("event_date").alias("first_date"))
        .groupBy(period_start(F.col("first_date"), period).alias("period_start"))
        .agg(F.count(F.lit(1)).alias("new_users"))
    )


def active_users_by_source(events: DataFrame) -> DataFrame:
    """Distinct active users per day and acquisition channel."""
    return (
        placed(events)
        .select("event_date", "utm_source", "user_id")
        .distinct()
        .groupBy("event_date", "utm_source")
        .agg(F.count(F.lit(1)).alias("active_users"))
    )
