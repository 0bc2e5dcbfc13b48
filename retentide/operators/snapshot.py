"""One row per user as of a day, from which the next day follows without the days before.

The row holds what all later stages need of a user's history: the running streak (and the last day of the
one before it), the open state range, the last days with activity, earnings and redemptions, and the balance.
A day's step joins it with that day's active users, so its cost is that of the users, whatever the number of
days. Days are numbers since 1970-01-01.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentide.functions.calendar import PERIODS, as_date, period_index
from retentide.operators.growth import RETENTION_OFFSETS
from retentide.schemas import DEFAULT_WINDOW, MILES, USER_SNAPSHOT


def state_on(day: Column, first: Column, last: Column, prev_last: Column, window: int) -> Column:
    """(user_state, since) on a day in, or after, the streak from ``first`` to ``last``, in closed form.

    See :func:`retentide.operators.states.streak_ranges`, whose open range this is.
    """
    def state(name: str, since: Column) -> Column:
        return F.struct(F.lit(name).alias("user_state"), since.alias("since"))

    faded = prev_last + 2 * window
    return (
        F.when(day - last >= window, state("churned", last + window))
        .when(day - first >= window, state("retained", first + window))
        .when(prev_last.isNull(), state("new", first))
        .when(day < faded, state("retained", first))
        .otherwise(state("resurrected", F.greatest(first, faded)))
    )


def user_snapshot(daily: DataFrame, as_of: date, window: int = DEFAULT_WINDOW, metrics: bool = True) -> DataFrame:
    """The snapshot of ``as_of`` from the whole daily activity, combined on the map side."""
    day, days = F.unix_date("event_date"), F.col("days")

    def apart(a: Column, b: Column) -> Column:
        return a.isNull() | b.isNull() | (b - a > window)

    opens = F.filter(days, lambda d, i: apart(F.get(days, i - 1), d))
    closes = F.filter(days, lambda d, i: apart(d, F.get(days, i + 1)))
    users = (
        daily.where(F.col("user_id").isNotNull() & (F.col("event_date") <= as_date(as_of)))
        .groupBy("user_id")
        .agg(
            F.sort_array(F.collect_set(day)).alias("days"),
            F.max(F.when(F.col("cnt_miles_earned") > 0, day)).alias("earn_day"),
            F.max(F.when(F.col("cnt_miles_redeemed") > 0, day)).alias("redeem_day"),
            F.sum(F.col("miles_earned_sum") - F.col("miles_redeemed_sum")).cast(MILES).alias("balance"),
        )
        .select("*", opens.alias("opening"), closes.alias("closing"))
        .select(
            "user_id", "earn_day", "redeem_day", "balance",
            F.get("days", F.lit(0)).alias("epoch"),
            F.element_at("opening", -1).alias("first"),
            F.element_at("closing", -1).alias("last"),
            F.try_element_at("closing", F.lit(-2)).alias("prev_last"),
        )
    )
    now = state_on(F.unix_date(as_date(as_of)), F.col("first"), F.col("last"), F.col("prev_last"), window)
    return _finished(users.select("*", now.alias("now")).select("*", "now.user_state", "now.since"), as_of, window, metrics)


def _finished(users: DataFrame, day: date, window: int, metrics: bool) -> DataFrame:
    fixed = {"event_date": as_date(day), "window": F.lit(window), "metrics": F.lit(metrics)}
    fields = [f for f in USER_SNAPSHOT.fields]
    columns = [fixed[f.name] if f.name in fixed else F.col(f.name) if f.name in users.columns else F.lit(None) for f in fields]
    return users.select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(columns, fields, strict=True)])


def advance(snapshot: DataFrame, daily: DataFrame, day: date, window: int = DEFAULT_WINDOW, metrics: bool = True) -> DataFrame:
    """The snapshot of ``day`` from that of the day before and the daily activity of ``day``.

    For those who are active, ``before`` is their last active day until then, and ``earn_before`` and
    ``redeem_before`` are those of earnings and redemptions. ``since`` is ``day`` where a state begins
    then, and ``closed_since`` the start of the range it ends.
    """
    today = daily.select(
        "user_id",
        (F.col("cnt_miles_earned") > 0).alias("earned"),
        (F.col("cnt_miles_redeemed") > 0).alias("redeemed"),
        (F.col("miles_earned_sum") - F.col("miles_redeemed_sum")).alias("net"),
    )
    now, here = F.unix_date(as_date(day)), F.col("earned").isNotNull()
    opens = here & (F.col("last").isNull() | (now - F.col("last") > window))
    earned, redeemed = F.coalesce("earned", F.lit(False)), F.coalesce("redeemed", F.lit(False))
    moved = snapshot.join(today, "user_id", "full_outer").select(
        "user_id",
        F.coalesce("epoch", now).alias("epoch"),
        F.when(opens, now).otherwise(F.col("first")).alias("first"),
        F.when(here, now).otherwise(F.col("last")).alias("last"),
        F.when(opens, F.col("last")).otherwise(F.col("prev_last")).alias("prev_last"),
        F.when(here, F.col("last")).alias("before"),
        F.when(earned, now).otherwise(F.col("earn_day")).alias("earn_day"),
        F.when(earned, F.col("earn_day")).alias("earn_before"),
        F.when(redeemed, now).otherwise(F.col("redeem_day")).alias("redeem_day"),
        F.when(redeemed, F.col("redeem_day")).alias("redeem_before"),
        (F.coalesce("balance", F.lit(0)) + F.coalesce("net", F.lit(0))).alias("balance"),
        F.col("since").alias("old_since"),
    )
    state = state_on(now, F.col("first"), F.col("last"), F.col("prev_last"), window)
    found = moved.select("*", state.alias("now")).select("*", "now.user_state", "now.since")
    found = found.withColumn("closed_since", F.when(F.col("since") == now, F.col("old_since")))
    return _finished(found, day, window, metrics)


# What a day adds, read from its snapshot


def opened_ranges(snapshot: DataFrame, day: date) -> DataFrame:
    """The state ranges that begin on ``day``, open."""
    begins = snapshot.where(F.col("since") == F.unix_date(as_date(day)))
    return begins.select("user_id", "user_state", as_date(day).alias("start_date"), F.lit(None).cast("date").alias("end_date"))


def close_ranges(ranges: DataFrame, snapshot: DataFrame, day: date) -> DataFrame:
    """``ranges`` with those that end on the day before ``day`` closed."""
    ended = snapshot.where(F.col("closed_since").isNotNull()).select(
        "user_id", F.date_from_unix_date("closed_since").alias("start_date"), F.lit(True).alias("ended")
    )
    end = F.when(F.col("ended"), F.date_sub(as_date(day), 1)).otherwise(F.col("end_date"))
    joined = ranges.join(ended, ["user_id", "start_date"], "left")
    return joined.select("user_id", "user_state", "start_date", end.alias("end_date"))


def day_counts(snapshot: DataFrame, day: date) -> DataFrame:
    """One row of counts over the users who are active on ``day``: for each calendar period those who
    weren't counted in it yet, by state, and the new earners and redeemers; and who came back in each
    cohort of ``RETENTION_OFFSETS``."""
    now = F.unix_date(as_date(day))
    counts = [F.count_if(F.col("epoch") == now).alias("new")]
    for period in PERIODS:
        here = period_index(as_date(day), period)

        def of(column: str) -> Column:
            return period_index(F.date_from_unix_date(column), period)

        def first_time(done: str, before: str) -> Column:
            return (F.col(done) == now) & (F.col(before).isNull() | (of(before) < here))

        counts += [
            F.count_if(F.col("before").isNull()).alias(f"{period}_new_users"),
            F.count_if(of("before") == here - 1).alias(f"{period}_retained_users"),
            F.count_if(of("before") < here - 1).alias(f"{period}_resurrected_users"),
            F.count_if(first_time("earn_day", "earn_before")).alias(f"{period}_earners"),
            F.count_if(first_time("redeem_day", "redeem_before")).alias(f"{period}_redeemers"),
        ]
    counts += [F.count_if(F.col("epoch") == now - n).alias(f"back_{n}") for n in RETENTION_OFFSETS]
    return snapshot.where(F.col("last") == now).agg(*counts)
