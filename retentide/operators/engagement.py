"""How much active users do: depth per period, and session frequency."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from retentide.functions.calendar import period_start
from retentide.operators.activity import placed
from retentide.schemas import MILES

SESSION_GAP_SECONDS = 30 * 60


def engagement_depth(daily: DataFrame, period: str = "day") -> DataFrame:
    """Events and miles per active user, and users who redeemed per user who earned.

    Reads the rows of ``user_daily_activity``. Users are counted once per period; a ratio
    over nobody is NULL.
    """
    per_user = daily
    if period != "day":
        per_user = daily.groupBy(
            period_start(F.col("event_date"), period).alias("event_date"), "user_id"
        ).agg(
            *[
                F.sum(c).alias(c)
                for c in ("total_events", "miles_earned_sum", "cnt_miles_earned", "cnt_miles_redeemed")
            ]
        )
    totals = per_user.groupBy(F.col("event_date").alias("period_start")).agg(
        F.count(F.lit(1)).alias("active_users"),
        F.sum("total_events").alias("total_events"),
        F.sum("miles_earned_sum").cast(MILES).alias("miles_earned"),
        F.count_if(F.col("cnt_miles_earned") > 0).alias("earners"),
        F.count_if(F.col("cnt_miles_redeemed") > 0).alias("redeemers"),
    )
    return with_ratios(totals)


def with_ratios(totals: DataFrame) -> DataFrame:
    """Totals of a period with what they make per user."""
    return totals.select(
        "*",
        F.try_divide("total_events", "active_users").alias("events_per_user"),
        F.try_divide(F.col("miles_earned").cast("double"), "active_users").alias("miles_per_user"),
        F.try_divide("redeemers", "earners").alias("redemption_rate"),
    )


def session_frequency(
    events: DataFrame, period: str = "week", gap_seconds: int = SESSION_GAP_SECONDS
) -> DataFrame:
    """Active days and sessions per user and period.

    A session ends when the user does nothing for more than ``gap_seconds``; it counts in the
    period in which it starts. Events less than a gap apart cannot be in different sessions,
    so they are first folded into slots of one gap's length. That runs on the map side and
    leaves a user at most one row per slot, however many events there are.
    """
    return _per_period(_sessions(_slots(events, gap_seconds), gap_seconds), period)


def _slots(events: DataFrame, gap_seconds: int) -> DataFrame:
    """First and last event of each user in slots of one gap's length, in microseconds."""
    micros = F.unix_micros("event_time")
    slot = micros - F.pmod(micros, F.lit(gap_seconds * 1_000_000))
    return placed(events).groupBy("user_id", "event_date", slot.alias("slot")).agg(F.min(micros).alias("begins"), F.max(micros).alias("ends"))


def _sessions(slots: DataFrame, gap_seconds: int) -> DataFrame:
    """For each slot whether a session, and whether a day, starts with it."""
    by_time = W.partitionBy("user_id").orderBy("begins")
    flagged = slots.select(
        "user_id",
        "event_date",
        (F.col("begins") - F.lag("ends").over(by_time)).alias("pause"),
        F.lag("event_date").over(by_time).alias("date_before"),
    )
    starts = F.col("pause").isNull() | (F.col("pause") > gap_seconds * 1_000_000)
    new_day = F.col("date_before").isNull() | (F.col("date_before") != F.col("event_date"))
    return flagged.select("user_id", "event_date", starts.alias("starts"), new_day.alias("new_day"))


def _per_period(sessions: DataFrame, period: str) -> DataFrame:
    return _with_rate(
        sessions.groupBy("user_id", period_start(F.col("event_date"), period).alias("period_start")).agg(
            F.count_if("new_day").alias("active_days"), F.count_if("starts").alias("sessions")
        )
    )


def _with_rate(counts: DataFrame) -> DataFrame:
    return counts.withColumn("sessions_per_active_day", F.try_divide("sessions", "active_days"))


def open_sessions(events: DataFrame, day: date, gap_seconds: int = SESSION_GAP_SECONDS) -> DataFrame:
    """Users whose session of ``day`` may go on after midnight, with the time of their last event.

    ``gap_seconds`` may be a day at most. A user has one row, and only those of the day's last gap have any.
    """
    last_gap = F.lit(datetime.combine(day, time()) + timedelta(days=1, seconds=-gap_seconds)).cast("timestamp")
    late = placed(events).where((F.col("event_date") == F.lit(day)) & (F.col("event_time") >= last_gap))
    return late.groupBy("user_id").agg(F.max("event_time").alias("last_time")).withColumn("event_date", F.lit(day))


def day_sessions(
    events: DataFrame, still_open: DataFrame, day: date, period: str = "week", gap_seconds: int = SESSION_GAP_SECONDS
) -> DataFrame:
    """What ``day`` adds to :func:`session_frequency`, from its events and the open sessions of the day before."""
    at = F.unix_micros("last_time")
    carried = still_open.select("user_id", "event_date", at.alias("begins"), at.alias("ends"))
    slots = _slots(events, gap_seconds).drop("slot").unionByName(carried)
    return _per_period(_sessions(slots, gap_seconds).where(F.col("event_date") == F.lit(day)), period)


def merged_sessions(held: DataFrame, added: DataFrame) -> DataFrame:
    """Counts of a period's earlier days and those of a new day, by user."""
    counts = held.unionByName(added).groupBy("user_id", "period_start")
    return _with_rate(counts.agg(F.sum("active_days").alias("active_days"), F.sum("sessions").alias("sessions")))
