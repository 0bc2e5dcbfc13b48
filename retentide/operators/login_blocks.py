"""Login histories in blocks of days: one row, and one word, for a device and block with activity.

A day of login bitmaps has a row for each device seen so far and a character for each day since, so a history
of d days takes d² characters a device. Here a day changes one bit of the devices that are active on it, and
devices that are idle for a whole block have no row in it. Bitmaps of any day, and counts of any window, come
from the words; a window reads the blocks that it touches and no others.

The first event of a device in a block stands in its row, so the attributes of a device are those of its
earliest block, whatever order days are loaded in.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentide.functions.bitmaps import bitmap_of_days, device_id
from retentide.functions.calendar import as_date
from retentide.operators.activity import placed
from retentide.operators.bitmaps import unfolded
from retentide.schemas import LOGIN_BLOCKS

#: Days of a block; blocks are counted from 1970-01-01.
BLOCK_DAYS = 32
DEVICE = ("platform", "user_id")


def block_start(day: date) -> date:
    """The first day of the block that ``day`` is in."""
    return day - timedelta(days=(day - date(1970, 1, 1)).days % BLOCK_DAYS)


def _block_start(day: Column) -> Column:
    return F.date_sub(day, F.pmod(F.unix_date(day), F.lit(BLOCK_DAYS)))


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place)


def _folded(rows: DataFrame) -> DataFrame:
    """Words of the same device and block as one; combined before the shuffle."""
    first = F.min(F.struct("first_time", "country", "utm_source")).alias("first")
    found = rows.groupBy(*DEVICE, "block").agg(F.bit_or("days").alias("days"), first)
    return found.select(*DEVICE, "days", "first.*", "block").select(*LOGIN_BLOCKS.fieldNames())


def login_blocks(events: DataFrame) -> DataFrame:
    """The blocks of all events; those without a user or a day are left out."""
    bit = _bit(F.pmod(F.unix_date("event_date"), F.lit(BLOCK_DAYS)))
    rows = placed(events).select(
        *DEVICE, bit.alias("days"), F.col("event_time").alias("first_time"), "country", "utm_source", _block_start(F.col("event_date")).alias("block")
    )
    return _folded(rows)


def merged(held: DataFrame, events: DataFrame) -> DataFrame:
    """Blocks with the events of further days added; the order in which days come doesn't matter."""
    return _folded(held.select(*LOGIN_BLOCKS.fieldNames()).unionByName(login_blocks(events)))


def days_between(first: date | str | Column, last: date | str | Column) -> Column:
    """The bits of a row's word that stand for days from ``first`` to ``last``."""
    place = F.unix_date("block")
    low = F.greatest(F.unix_date(as_date(first)) - place, F.lit(0))
    high = F.least(F.unix_date(as_date(last)) - place, F.lit(BLOCK_DAYS - 1))
    mask = F.when(low <= high, _bit(high + 1) - _bit(low)).otherwise(F.lit(0).cast("bigint"))
    return F.col("days").bitwiseAND(mask)


def histories_of(blocks: DataFrame, as_of: date | str | Column) -> DataFrame:
    """One row per device with its whole bitmap up to ``as_of``, as :func:`bitmaps.device_histories` gives it
    from the events. Shuffles a word for each block in which a device is active."""
    as_of = as_date(as_of)
    until = blocks.where(F.col("block") <= as_of).withColumn("days", days_between(F.col("block"), as_of)).where("days <> 0")
    words = F.sort_array(F.collect_list(F.struct(F.unix_date("block").alias("start"), "days")))

    def days_of(word: Column) -> Column:
        here = F.filter(F.sequence(F.lit(0), F.lit(BLOCK_DAYS - 1)), lambda k: F.getbit(word["days"], k) == 1)
        return F.transform(here, lambda k: word["start"] + k)

    return (
        until.groupBy(*DEVICE)
        .agg(words.alias("words"), F.min(F.struct("first_time", "country", "utm_source")).alias("earliest"))
        .withColumn("days", F.flatten(F.transform("words", days_of)))
        .withColumn("end", F.unix_date(as_of))
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


def bitmaps_of(blocks: DataFrame, first: date | str | Column | None, last: date | str | Column) -> DataFrame:
    """The login bitmaps of the days from ``first``, or all, to ``last``: the rows that the daily step makes."""
    return unfolded(histories_of(blocks, last), first)


def window_counts(blocks: DataFrame, as_of: date | str | Column, window: int) -> DataFrame:
    """(user_id, current_days, prior_days): distinct active days of a user in the ``window`` days up to ``as_of`` and in
    as many before them, over all devices. Users without any are left out; blocks before the windows aren't read."""
    as_of = as_date(as_of)
    begin, middle = F.date_sub(as_of, 2 * window - 1), F.date_sub(as_of, window - 1)
    near = blocks.where((F.col("block") <= as_of) & (F.col("block") > F.date_sub(as_of, 2 * window - 1 + BLOCK_DAYS)))
    by_user = near.groupBy("user_id", "block").agg(F.bit_or("days").alias("days"))
    counted = by_user.select(
        "user_id",
        F.bit_count(days_between(middle, as_of)).alias("current"),
        F.bit_count(days_between(begin, F.date_sub(middle, 1))).alias("prior"),
    )
    found = counted.groupBy("user_id").agg(F.sum("current").alias("current_days"), F.sum("prior").alias("prior_days"))
    return found.where("current_days + prior_days > 0")
