"""User states over two adjoining activity windows, and their date ranges.

On day d a user has ``active_now`` active days in the window of w days that ends on d, and
``active_prior`` in the window before it. From these follow the states

* new          first seen less than w days ago, active now
* resurrected  active now, not in the prior window
* retained     active in both
* churned      active in the prior window only

and no row when neither window has activity. Consecutive days in one state make a range.

There are three ways to the same ranges:

* :func:`user_states`  from streaks of activity. The default: its work grows with the number
  of active days, and with any window length.
* :func:`user_states_from_bitmaps`  from the daily bitmaps, one row per user and day, both
  windows read from the words of the whole history.
* :func:`window_counts`  exact window counts at the only days on which a state can change.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import WindowSpec
from pyspark.sql import functions as F

from retentide.functions.bitmaps import active_days_in, bitmap_to_words
from retentide.functions.calendar import as_date
from retentide.operators.activity import user_calendars
from retentide.schemas import DEFAULT_WINDOW


def _by_user_day() -> WindowSpec:
    return W.partitionBy("user_id").orderBy("event_date")


# From streaks


def activity_streaks(
    activity: DataFrame, as_of: date | str | Column, window: int = DEFAULT_WINDOW
) -> DataFrame:
    """Collapse active days whose gaps are at most ``window`` days into streaks.

    ``activity`` is any rows with (user_id, event_date); repeated ones change nothing. Day
    numbers: ``first`` and ``last`` of the streak, the ``prev_last`` active day before it and
    the ``next_first`` after it. The n-th opening day belongs to the n-th closing day.
    """
    days = F.col("periods")

    def opens(day: Column, i: Column) -> Column:
        return F.coalesce(day - F.get(days, i - 1) > window, F.lit(True))

    def closes(day: Column, i: Column) -> Column:
        return F.coalesce(F.get(days, i + 1) - day > window, F.lit(True))

    streak = F.col("streak")
    return (
        user_calendars(activity, as_of)
        .select("user_id", F.filter(days, opens).alias("opening"), F.filter(days, closes).alias("closing"))
        .select("*", F.posexplode("opening").alias("streak", "first"))
        .select(
            "user_id",
            "first",
            F.get("closing", streak).alias("last"),
            F.get("closing", streak - 1).alias("prev_last"),
            F.get("opening", streak + 1).alias("next_first"),
        )
    )


def streak_ranges(
    streaks: DataFrame, as_of: date | str | Column, window: int = DEFAULT_WINDOW
) -> DataFrame:
    """The state ranges each streak brings, in closed form.

    A streak is active now from ``first`` to ``last + w - 1`` and active in the prior window
    from ``first + w`` to ``last + 2w - 1``; both hold for each streak on its own, as the gap
    to the next one is longer than w. So a streak starts as new, or as retained while the
    streak before it still reaches into the prior window and as resurrected from then on;
    is retained from ``first + w`` if it has a second day; and is churned from ``last + w``
    until the next streak starts.
    """
    first, last, before = F.col("first"), F.col("last"), F.col("prev_last")
    fading = first - before < 2 * window
    resurrected = F.when(fading, before + 2 * window)
    retained = F.when(last > first, first + window)
    churned = last + window

    def piece(state: Column | str, start: Column, following: Column) -> Column:
        state = F.lit(state) if isinstance(state, str) else state
        return F.struct(state.alias("user_state"), start.alias("start"), following.alias("following"))

    pieces = F.array(
        piece(
            F.when(before.isNull(), "new").when(fading, "retained").otherwise("resurrected"),
            first,
            F.coalesce(resurrected, retained, churned),
        ),
        piece("resurrected", resurrected, F.coalesce(retained, churned)),
        piece("retained", retained, churned),
        piece("churned", churned, F.col("next_first")),
    )
    end = F.unix_date(as_date(as_of))
    return (
        streaks.select("user_id", F.inline(pieces))
        .where(F.col("start") <= end)
        .select(
            "user_id",
            "user_state",
            F.date_from_unix_date("start").alias("start_date"),
            F.when(
                F.col("following") <= end, F.date_from_unix_date(F.col("following") - 1)
            ).alias("end_date"),
        )
    )


def user_states(
    activity: DataFrame, as_of: date | str | Column, window: int = DEFAULT_WINDOW
) -> DataFrame:
    """State ranges per user up to ``as_of``; the open range has no end date."""
    return streak_ranges(activity_streaks(activity, as_of, window), as_of, window)


# From bitmaps


def user_epochs(bitmaps: DataFrame) -> DataFrame:
    """The first registration date over all devices of a user."""
    return bitmaps.groupBy("user_id").agg(F.min("reg_date").alias("uid_reg_date"))


def with_user_epoch(bitmaps: DataFrame) -> DataFrame:
    """Bitmap rows with the epoch of their user."""
    return bitmaps.join(user_epochs(bitmaps), "user_id")


def user_daily_bits(bitmaps: DataFrame) -> DataFrame:
    """The whole history of each user and day as words of 63 days, devices or-ed together.

    All bitmaps of a day end on that day, so they line up at the low bit of the first word as they
    are; padding them to the user's epoch would only add leading zeros. Words are or-ed one by one, so
    a user's devices are combined on the map side, however many there are.
    """
    words = bitmaps.where(F.col("user_id").isNotNull()).select(
        "user_id", "event_date", "reg_date", F.posexplode(bitmap_to_words(F.col("login_bitmap"))).alias("place", "word")
    )
    ored = words.groupBy("user_id", "event_date", "place").agg(
        F.bit_or("word").alias("word"), F.min("reg_date").alias("reg_date")
    )
    whole = ored.groupBy("user_id", "event_date").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("place", "word"))), lambda w: w["word"]
        ).alias("uid_bits"),
        F.min("reg_date").alias("reg_date"),
    )
    return whole.select(
        "user_id",
        "event_date",
        F.min("reg_date").over(W.partitionBy("user_id")).alias("uid_reg_date"),
        "uid_bits",
    )


def counts_from_bits(daily_bits: DataFrame, window: int = DEFAULT_WINDOW) -> DataFrame:
    """Active days in both windows and days since registration."""
    return daily_bits.select(
        "user_id",
        "event_date",
        active_days_in(F.col("uid_bits"), window).alias("active_now"),
        active_days_in(F.col("uid_bits"), window, skip=window).alias("active_prior"),
        F.datediff("event_date", "uid_reg_date").cast("bigint").alias("days_since_reg"),
    )


def classify(counts: DataFrame, window: int = DEFAULT_WINDOW) -> DataFrame:
    """The state of each row of window counts; rows without activity in either are dropped."""
    now, prior = F.col("active_now"), F.col("active_prior")
    seen_for = F.col("days_since_reg")
    return counts.where((now > 0) | (prior > 0)).select(
        "user_id",
        "event_date",
        F.when(now == 0, "churned")
        .when(seen_for < window, "new")
        .when(prior > 0, "retained")
        .otherwise("resurrected")
        .alias("user_state"),
    )


def user_states_from_bitmaps(bitmaps: DataFrame, window: int = DEFAULT_WINDOW) -> DataFrame:
    """State ranges per user from the daily bitmaps of all days."""
    counts = counts_from_bits(user_daily_bits(bitmaps), window)
    return close_ranges(segments(islands(classify(counts, window))))


# From window counts at the days that matter


def window_counts(
    activity: DataFrame, as_of: date | str | Column, window: int = DEFAULT_WINDOW
) -> DataFrame:
    """Exact window counts at every day on which they can start or stop being zero.

    An active day enters the current window on that day, moves to the prior one ``window``
    days later and leaves it after as many more; between those days no state changes.
    """
    by_day = W.partitionBy("user_id").orderBy("day")
    days = F.col("periods")
    aged = F.transform(days, lambda d: d + window)
    gone = F.transform(days, lambda d: d + 2 * window)
    entering = F.transform(days, lambda d: F.struct(d.alias("day"), F.lit(1).alias("active")))
    leaving = F.transform(
        F.array_except(F.array_union(aged, gone), days),
        lambda d: F.struct(d.alias("day"), F.lit(0).alias("active")),
    )
    points = (
        user_calendars(activity, as_of)
        .select("user_id", F.inline(F.concat(entering, leaving)))
        .where(F.col("day") <= F.unix_date(as_date(as_of)))
    )
    now = by_day.rangeBetween(-(window - 1), 0)
    prior = by_day.rangeBetween(-(2 * window - 1), -window)
    so_far = by_day.rowsBetween(W.unboundedPreceding, 0)
    return points.select(
        "user_id",
        F.date_from_unix_date("day").alias("event_date"),
        F.sum("active").over(now).alias("active_now"),
        F.coalesce(F.sum("active").over(prior), F.lit(0).cast("bigint")).alias("active_prior"),
        (F.col("day") - F.min("day").over(so_far)).cast("bigint").alias("days_since_reg"),
    )


# Islands and ranges


def state_changes(states: DataFrame) -> DataFrame:
    """Flag the rows whose state differs from the user's row before; the first row counts."""
    same = F.col("user_state") == F.lag("user_state").over(_by_user_day())
    return states.withColumn("is_new_segment", F.when(same, 0).otherwise(1))


def islands(states: DataFrame) -> DataFrame:
    """Number the runs of equal state of each user, from 1."""
    so_far = _by_user_day().rowsBetween(W.unboundedPreceding, 0)
    return state_changes(states).select(
        "user_id",
        "event_date",
        "user_state",
        F.sum("is_new_segment").over(so_far).alias("segment_id"),
    )


def segments(numbered: DataFrame) -> DataFrame:
    """One row per run with its first and last day."""
    return numbered.groupBy("user_id", "user_state", "segment_id").agg(
        F.min("event_date").alias("start_date"), F.max("event_date").alias("last_date")
    )


def close_ranges(runs: DataFrame) -> DataFrame:
    """End each range the day before the user's next one starts; the last stays open."""
    by_start = W.partitionBy("user_id").orderBy("start_date")
    return runs.select(
        "user_id",
        "user_state",
        "start_date",
        F.date_sub(F.lead("start_date").over(by_start), 1).alias("end_date"),
    )
