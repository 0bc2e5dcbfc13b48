"""Expressions on login bitmaps: '0'/'1' strings whose last character is the row's own day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bits of a word: a bigint holds so many without its sign.
WORD_BITS = 63


def device_id(platform: Column, user_id: Column) -> Column:
    return F.concat(platform, F.lit("_"), user_id)


def bitmap_to_words(bitmap: Column) -> Column:
    """The whole bitmap as integers of 63 bits, the newest days first: the newest day is the lowest bit
    of the first word, so that bitmaps of any length that end on the same day line up."""

    def words_of(digits: Column) -> Column:
        length = F.length(digits)
        count = F.greatest(F.lit(1), F.ceil(length / WORD_BITS).cast("int"))

        def word(k: Column) -> Column:
            end = length - k * WORD_BITS
            start = F.greatest(F.lit(1), end - (WORD_BITS - 1))
            return F.conv(F.substring(digits, start, end - start + 1).cast("string"), 2, 10).cast("bigint")

        return F.transform(F.sequence(F.lit(0), count - 1), word)

    # Bytes are cut at once, where a string is walked character by character from its start for each word. As the
    # element of an array the bitmap is computed once, not for each word.
    return F.get(F.transform(F.array(bitmap.cast("binary")), words_of), F.lit(0))


def word_at(words: Column, k: int | Column) -> Column:
    """A word, or zero beyond the last one."""
    return F.coalesce(F.get(words, F.lit(k) if isinstance(k, int) else k), F.lit(0).cast("bigint"))


def active_days_in(words: Column, window: int, skip: int = 0) -> Column:
    """Set bits among the ``window`` days that end ``skip`` days before the newest one."""
    total = F.lit(0)
    for k in range(skip // WORD_BITS, (skip + window - 1) // WORD_BITS + 1):
        low, high = max(skip - k * WORD_BITS, 0), min(skip + window - k * WORD_BITS, WORD_BITS)
        mask = F.lit((1 << (high - low)) - 1).cast("bigint")
        total = total + F.bit_count(F.shiftright(word_at(words, k), low).bitwiseAND(mask))
    return total.cast("bigint")


def bitmap_of_days(days: Column, end: Column) -> Column:
    """The bitmap from the first of the sorted day numbers ``days`` up to day number ``end``.

    Each active day contributes a '1' and the '0's up to the next active day, which is
    linear in the length of the result.
    """

    def run(day: Column, i: Column) -> Column:
        following = F.coalesce(F.get(days, i + 1), end + 1)
        return F.concat(F.lit("1"), F.repeat(F.lit("0"), following - day - 1))

    return F.array_join(F.transform(days, run), "")
