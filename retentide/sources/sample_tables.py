"""The sample tables read as loyalty events.

Only this module knows the sample tables; everything else takes the event contract.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retentide.session import require_utc

SCHEMAS = {
    "events": T.StructType(
        [
            T.StructField("event_id", T.LongType()),
            T.StructField("ts", T.TimestampNTZType()),
            T.StructField("user_id", T.LongType()),
            T.StructField("event_type", T.StringType()),
            T.StructField("value", T.DoubleType()),
            T.StructField("props", T.StringType()),
        ]
    ),
    "orders": T.StructType(
        [
            T.StructField("o_orderkey", T.LongType()),
            T.StructField("o_custkey", T.LongType()),
            T.StructField("o_orderstatus", T.StringType()),
            T.StructField("o_totalprice", T.DoubleType()),
            T.StructField("o_orderdate", T.TimestampNTZType()),
            T.StructField("o_orderpriority", T.StringType()),
        ]
    ),
}


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return require_utc(spark).read.schema(SCHEMAS[table]).parquet(f"{sf_dir}/{table}.parquet")


def _one_of(number: Column, values: tuple[str, ...]) -> Column:
    """The value at position ``number % len(values)``."""
    position = F.pmod(number, F.lit(len(values)))
    picked = F.when(position == 0, values[0])
    for i, value in enumerate(values[1:-1], start=1):
        picked = picked.when(position == i, value)
    return picked.otherwise(values[-1])


def _padded_id(prefix: str, number: Column, width: int) -> Column:
    """``prefix`` and at least ``width`` digits; a longer number keeps all of its digits."""
    digits = number.cast("string")
    return F.concat(
        F.lit(prefix),
        F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, width, "0")),
    )


def _as_loyalty_events(events: DataFrame) -> DataFrame:
    user, kind = F.col("user_id"), F.col("event_type")
    app = _one_of(user, ("android", "ios", "web"))
    return events.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("event_time"),
        _padded_id("u_", user, 4).alias("user_id"),
        _one_of(user, ("Male", "Female", "Non-binary", "Prefer not to say")).alias("gender"),
        F.when(kind == "purchase", "miles_earned")
        .when(kind == "signup", "miles_redeemed")
        .when(kind == "view", "reward_search")
        .when(kind == "click", "like")
        .otherwise("share")
        .alias("event_type"),
        F.when(
            kind.isin("purchase", "signup", "view"), F.get_json_object("props", "$.k")
        ).alias("transaction_category"),
        F.when(kind.isin("purchase", "signup"), F.col("value")).alias("miles_amount"),
        F.when(F.col("event_id") % 10 == 0, "web").otherwise(app).alias("platform"),
        _one_of(user, ("organic", "facebook", "tiktok", "google", "referral")).alias("utm_source"),
        _one_of(F.expr("user_id DIV 5"), ("MY", "PH", "TH", "ID", "SG")).alias("country"),
        F.to_date("ts").alias("event_date"),
    )


def loyalty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` in the event contract, plus ``event_id`` and ``event_date``."""
    return _as_loyalty_events(read_table(spark, sf_dir, "events"))


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as user activity over several years: (user_id, event_date)."""
    return read_table(spark, sf_dir, "orders").select(
        _padded_id("c_", F.col("o_custkey"), 8).alias("user_id"),
        F.to_date("o_orderdate").alias("event_date"),
    )
