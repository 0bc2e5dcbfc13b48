"""Data-quality checks as (check, n_bad) rows, all checks of one table in one pass.

A check on a NULL value fails unless the rule says otherwise.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentide import schemas
from retentide.functions.calendar import as_date


def violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows that break each rule; ``rules`` maps a check to the condition that has to hold."""
    counts = df.agg(
        *[
            F.count_if(~F.coalesce(holds, F.lit(False))).alias(check)
            for check, holds in rules.items()
        ]
    )
    return counts.unpivot([], list(rules), "check", "n_bad")


# Events


def event_rules() -> dict[str, Column]:
    """The contract of one raw event."""
    kind, amount = F.col("event_type"), F.col("miles_amount")
    moves_miles = F.coalesce(kind.isin(*schemas.MILES_EVENT_TYPES), F.lit(False))
    without_miles = F.coalesce(
        kind.isin(*[t for t in schemas.EVENT_TYPES if t not in schemas.MILES_EVENT_TYPES]),
        F.lit(False),
    )
    return {
        "event_time_not_null": F.col("event_time").isNotNull(),
        "user_id_format": F.col("user_id").rlike(schemas.USER_ID_PATTERN),
        "event_type_known": kind.isin(*schemas.EVENT_TYPES),
        "miles_amount_positive": ~moves_miles | (amount > 0),
        "miles_amount_absent": ~without_miles | amount.isNull(),
        "country_known": F.col("country").isin(*schemas.COUNTRIES),
        "gender_known": F.col("gender").isin(*schemas.GENDERS),
        "platform_known": F.col("platform").isin(*schemas.PLATFORMS),
        "utm_source_known": F.col("utm_source").isin(*schemas.UTM_SOURCES),
    }


def event_assertions(events: DataFrame) -> DataFrame:
    """Run on raw events, before cleaning fills the missing miles."""
    return violations(events, event_rules())


# Row counts by day


def day_counts(df: DataFrame) -> DataFrame:
    """Rows per day."""
    return df.groupBy("event_date").agg(F.count(F.lit(1)).alias("row_count"))


def calendar_counts(
    df: DataFrame, first: date | str | Column, last: date | str | Column
) -> DataFrame:
    """Rows for each calendar day from ``first`` to ``last``, zero where there are none.

    One row per day of the calendar is all that either side of the join can hold.
    """
    counts = day_counts(df)
    calendar = F.sequence(as_date(first), as_date(last))
    days = df.sparkSession.range(1).select(F.explode(calendar).alias("event_date"))
    return days.join(counts, "event_date", "left").select(
        "event_date", F.coalesce("row_count", F.lit(0).cast("bigint")).alias("row_count")
    )


def empty_days(
    df: DataFrame, first: date | str | Column, last: date | str | Column, check: str
) -> DataFrame:
    """How many days of the range have no rows at all."""
    return violations(calendar_counts(df, first, last), {check: F.col("row_count") > 0})


def row_count_differences(source: DataFrame, table: DataFrame) -> DataFrame:
    """Rows per day in the source and in the loaded table.

    Both sides are counted in one aggregation, without a join.
    """
    sides = source.select("event_date", F.lit(True).alias("is_source")).unionByName(
        table.select("event_date", F.lit(False).alias("is_source"))
    )
    return (
        sides.groupBy("event_date")
        .agg(
            F.count_if("is_source").alias("source_rows"),
            F.count_if(~F.col("is_source")).alias("table_rows"),
        )
        .withColumn("matches", F.col("source_rows") == F.col("table_rows"))
    )


# Login bitmaps against the devices of the source; both sides may hold any number of days


def _endings(bitmaps: DataFrame) -> DataFrame:
    """What the checks need of a bitmap row; the bitmap itself is not shuffled."""
    return bitmaps.select(
        "event_date",
        "device",
        F.right("login_bitmap", F.lit(1)).alias("last_bit"),
        (F.col("login_bitmap") == "1").alias("is_single_login"),
        "isNew",
    )


def bitmap_row_rules() -> dict[str, Column]:
    return {
        "device_not_null": F.col("device").isNotNull(),
        "device_format": F.col("device").isNull() | F.col("device").rlike(schemas.DEVICE_PATTERN),
        "new_device_has_single_login": (F.col("isNew") != "1") | (F.col("login_bitmap") == "1"),
    }


def bitmap_row_checks(bitmaps: DataFrame) -> DataFrame:
    """Checks that need only the bitmap table."""
    return violations(bitmaps, bitmap_row_rules())


def missing_devices(bitmaps: DataFrame, active: DataFrame) -> DataFrame:
    """Active devices without a bitmap row on that day."""
    return active.select("event_date", "device").join(
        bitmaps.select("event_date", "device"), ["event_date", "device"], "left_anti"
    )


def active_without_login(bitmaps: DataFrame, active: DataFrame) -> DataFrame:
    """Active devices whose bitmap does not end in '1'."""
    return (
        _endings(bitmaps)
        .where("last_bit != '1'")
        .join(active.select("event_date", "device"), ["event_date", "device"], "left_semi")
        .select("event_date", "device")
    )


def login_without_activity(bitmaps: DataFrame, active: DataFrame) -> DataFrame:
    """Devices without activity whose bitmap does not end in '0'."""
    return (
        _endings(bitmaps)
        .where("last_bit != '0'")
        .join(active.select("event_date", "device"), ["event_date", "device"], "left_anti")
        .select("event_date", "device")
    )


def new_without_activity(bitmaps: DataFrame, active: DataFrame) -> DataFrame:
    """Devices marked as new without activity on that day."""
    return (
        _endings(bitmaps)
        .where("isNew = '1'")
        .join(active.select("event_date", "device"), ["event_date", "device"], "left_anti")
        .select("event_date", "device")
    )


def bitmap_checks(bitmaps: DataFrame, active: DataFrame) -> DataFrame:
    """All bitmap checks in one pass: one full outer join, then one aggregation.

    ``active`` has one row per day and device.
    """
    key = ["event_date", "device"]
    both = _endings(bitmaps).withColumn("in_table", F.lit(True)).join(
        active.select(*key).withColumn("in_source", F.lit(True)), key, "full_outer"
    )
    in_table = F.col("in_table").isNotNull()
    in_source = F.col("in_source").isNotNull()
    is_new = F.coalesce(F.col("isNew") == "1", F.lit(False))
    return violations(
        both,
        {
            "active_device_present": in_table | ~in_source,
            "device_not_null": F.col("device").isNotNull() | ~in_table,
            "device_format": F.col("device").isNull()
            | F.col("device").rlike(schemas.DEVICE_PATTERN)
            | ~in_table,
            "active_bitmap_ends_1": ~(in_table & in_source) | (F.col("last_bit") == "1"),
            "inactive_bitmap_ends_0": ~in_table | in_source | (F.col("last_bit") == "0"),
            "new_device_has_single_login": ~is_new | F.col("is_single_login"),
            "new_device_is_active": ~is_new | in_source,
        },
    )
