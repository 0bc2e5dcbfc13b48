"""Exact distinct users of rolling windows: users as dense numbers, days as bitmaps, windows as their union.

A user gets a number once. A day's users are then bitmaps of 4 KB for each 32,768 numbers, and the users of a
window are counted in the union of its days' bitmaps; no event and no user is read again for it.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from retentide.functions.calendar import as_date

ROLLING_WINDOWS = (7, 28)
#: Users are numbered in so many shares at once; their numbers stay dense, as shares are of about equal size.
SHARES = 256


def _share(user: str = "user_id"):
    return F.pmod(F.xxhash64(user), F.lit(SHARES)).cast("long")


def number_users(known: DataFrame, activity: DataFrame) -> DataFrame:
    """(user_id, user_no) for the users of ``activity`` that ``known`` (user_id, user_no) doesn't have.

    Numbers go on after the greatest of each share, which is their remainder."""
    users = activity.where(F.col("user_id").isNotNull()).select("user_id").distinct()
    fresh = users.join(known.select("user_id"), "user_id", "left_anti").withColumn("share", _share())
    so_far = known.groupBy(F.pmod("user_no", F.lit(SHARES)).alias("share")).agg(F.max("user_no").alias("most"))
    place = F.row_number().over(W.partitionBy("share").orderBy("user_id"))
    numbered = fresh.join(so_far, "share", "left").withColumn("place", place.cast("long"))
    start = F.coalesce(F.col("most"), F.col("share") - SHARES)
    return numbered.select("user_id", (start + F.col("place") * SHARES).alias("user_no"))


def daily_bitmaps(activity: DataFrame, numbers: DataFrame) -> DataFrame:
    """(event_date, bucket, users) of rows (user_id, event_date), by the users' numbers."""
    rows = activity.select("user_id", "event_date").join(numbers.select("user_id", "user_no"), "user_id")
    bucket, bit = F.bitmap_bucket_number("user_no"), F.bitmap_bit_position("user_no")
    return rows.groupBy("event_date", bucket.alias("bucket")).agg(F.bitmap_construct_agg(bit).alias("users"))


def rolling_active_users(
    bitmaps: DataFrame, first: date | str, last: date | str, windows: tuple[int, ...] = ROLLING_WINDOWS
) -> DataFrame:
    """(event_date, window_days, active_users): distinct users of the days up to each day from ``first`` to
    ``last``, a day without any included."""
    spark, longest = bitmaps.sparkSession, max(windows)
    ends = F.explode(F.sequence(F.lit(0), F.lit(longest - 1))).alias("age")
    near = bitmaps.where(F.col("event_date").between(F.date_sub(as_date(first), longest - 1), as_date(last)))
    aged = near.select("*", ends).select(F.date_add("event_date", F.col("age")).alias("day"), "bucket", "age", "users")
    of = [F.bitmap_count(F.bitmap_or_agg(F.when(F.col("age") < n, F.col("users")))).alias(f"w{n}") for n in windows]
    counted = aged.where(F.col("day").between(as_date(first), as_date(last))).groupBy("day", "bucket").agg(*of)
    summed = counted.groupBy("day").agg(*[F.sum(f"w{n}").alias(f"w{n}") for n in windows])
    calendar = spark.range(1).select(F.explode(F.sequence(as_date(first), as_date(last))).alias("event_date"))
    rows = calendar.join(summed, F.col("event_date") == F.col("day"), "left")
    by_window = F.array(*[F.struct(F.lit(n).cast("long").alias("window_days"), F.coalesce(f"w{n}", F.lit(0)).alias("active_users")) for n in windows])
    return rows.select("event_date", F.inline(by_window))
