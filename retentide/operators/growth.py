"""Growth accounting by calendar period, and cohort retention."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentide.functions.calendar import as_date, period_from_index, period_index
from retentide.operators.activity import user_calendars
from retentide.schemas import USER_STATES

RETENTION_OFFSETS = (1, 7, 14, 30)


def period_states(
    activity: DataFrame, period: str, as_of: date | str | Column
) -> DataFrame:
    """(user_id, period_start, user_state), comparing each period with the one before it.

    A user who stops is churned in the period after the last active one, unless that period
    lies after ``as_of``. ``activity`` is any rows with (user_id, event_date).
    """
    periods = F.col("periods")

    def entry(p: Column, i: Column) -> Column:
        before = F.get(periods, i - 1)
        state = (
            F.when(before.isNull(), "new").when(before == p - 1, "retained").otherwise("resurrected")
        )
        return F.struct(p.alias("period"), state.alias("user_state"))

    def is_left(p: Column, i: Column) -> Column:
        following = F.get(periods, i + 1)
        return (p < F.col("last_period")) & (following.isNull() | (following != p + 1))

    def leaving(p: Column) -> Column:
        return F.struct((p + 1).alias("period"), F.lit("churned").alias("user_state"))

    rows = F.concat(
        F.transform(periods, entry), F.transform(F.filter(periods, is_left), leaving)
    )
    return (
        user_calendars(activity, as_of, period)
        .withColumn("last_period", period_index(as_date(as_of), period))
        .select("user_id", F.inline(rows))
        .select("user_id", period_from_index(F.col("period"), period).alias("period_start"), "user_state")
    )


def growth_accounting(
    activity: DataFrame, period: str, as_of: date | str | Column
) -> DataFrame:
    """Active, new, retained, resurrected and churned users per calendar period."""
    state = F.col("user_state")
    return (
        period_states(activity, period, as_of)
        .groupBy("period_start")
        .agg(
            F.count_if(state != "churned").alias("active_users"),
            *[F.count_if(state == s).alias(f"{s}_users") for s in USER_STATES],
        )
    )


def cohort_retention(
    activity: DataFrame,
    as_of: date | str | Column,
    offsets: tuple[int, ...] = RETENTION_OFFSETS,
) -> DataFrame:
    """Share of each first-day cohort that is active again exactly N days later.

    Days after ``as_of`` have not been reached and give NULL, not zero. ``activity`` is any
    rows with (user_id, event_date).
    """
    days = F.col("periods")
    first = F.get(days, F.lit(0))
    cohorts = (
        user_calendars(activity, as_of)
        .groupBy(F.date_from_unix_date(first).alias("cohort_date"))
        .agg(
            F.count(F.lit(1)).alias("cohort_size"),
            *[F.count_if(F.array_contains(days, first + n)).alias(f"day_{n}") for n in offsets],
        )
    )
    by_offset = F.array(
        *[
            F.struct(F.lit(n).cast("bigint").alias("day_offset"), F.col(f"day_{n}").alias("back"))
            for n in offsets
        ]
    )
    reached = F.date_add("cohort_date", F.col("day_offset").cast("int")) <= as_date(as_of)
    return cohorts.select("cohort_date", "cohort_size", F.inline(by_offset)).select(
        "cohort_date",
        "cohort_size",
        "day_offset",
        F.when(reached, F.col("back")).alias("retained_users"),
        F.when(reached, F.try_divide(F.lit(100.0) * F.col("back"), "cohort_size")).alias(
            "retention_pct"
        ),
    )
