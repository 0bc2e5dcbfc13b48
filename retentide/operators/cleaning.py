"""Cleaning of bronze events. Assertions on the raw values run before this."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentide.schemas import MILES_EVENT_TYPES

EVENT_KEY = ("event_time", "user_id", "event_type")


def split_category(events: DataFrame) -> DataFrame:
    """``transaction_category`` as ``miles_category`` or ``search_brand``, by event type."""
    kind, category = F.col("event_type"), F.col("transaction_category")
    return events.withColumns(
        {
            "miles_category": F.when(kind.isin(*MILES_EVENT_TYPES), category),
            "search_brand": F.when(kind == "reward_search", category),
        }
    ).drop("transaction_category")


def fill_miles(events: DataFrame) -> DataFrame:
    """Zero miles where an event cannot move any; a miles event keeps its NULL."""
    amount = F.col("miles_amount")
    return events.withColumn(
        "miles_amount",
        F.when(F.col("event_type").isin(*MILES_EVENT_TYPES), amount).otherwise(
            F.coalesce(amount, F.lit(0.0))
        ),
    )


def add_is_transactional(events: DataFrame) -> DataFrame:
    return events.withColumn("is_transactional", F.col("event_type").isin(*MILES_EVENT_TYPES))


def dedup(events: DataFrame, key: tuple[str, ...] = EVENT_KEY) -> DataFrame:
    """One row per key: the least by the remaining columns in order, NULLs first.

    A minimum is combined before the shuffle, so any number of copies of one event costs
    one row per task.
    """
    rest = [c for c in events.columns if c not in key]
    least = events.groupBy(*key).agg(F.min(F.struct(*rest)).alias("least"))
    return least.select(*[c if c in key else f"least.{c}" for c in events.columns])


def clean(events: DataFrame) -> DataFrame:
    """Deduplicated events with the split category, filled miles and transaction flag."""
    return add_is_transactional(fill_miles(split_category(dedup(events))))
