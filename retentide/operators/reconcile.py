"""Reconciliation of two feeds by content, where equal counts prove nothing.

Both feeds are folded into fingerprints of (day, bucket of the row's hash) on the map side; only rows of the
buckets whose fingerprints differ are compared. The fingerprints are worked out when a function here is called,
as the plan depends on how many differ. Equal feeds therefore shuffle a few numbers a day and bucket,
and a damaged row costs the rows of two buckets of its day.

Rows are compared as a multiset, NULL being equal to NULL. Rows without a day form a day of their own. Empty
feeds have no differences. Columns beside the compared ones are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1024
# So many damaged buckets are named to all tasks, a few megabytes; if there are more, the rows are joined with them.
BROADCAST_BUCKETS = 100_000


def row_hash(columns: Sequence[str]) -> Column:
    """64-bit hash of a row. Spark's hash passes over NULLs, so which columns are NULL is hashed as well:
    a value that moves to another column changes the hash."""
    nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    return F.xxhash64(nulls, *columns)


def fingerprint(columns: Sequence[str]) -> Column:
    """An order-free fingerprint of the rows of a group: the sum of their hashes, exact."""
    return F.sum(row_hash(columns).cast("decimal(38,0)"))


def _both(source: DataFrame, table: DataFrame, columns: Sequence[str], buckets: int) -> DataFrame:
    def side(df: DataFrame, sign: int) -> DataFrame:
        kept = df.select(F.col("event_date").alias("_day"), *[F.col(c).alias(f"c_{c}") for c in columns])
        hashed = kept.withColumn("_hash", row_hash([f"c_{c}" for c in columns]))
        return hashed.withColumns({"_bucket": F.pmod("_hash", F.lit(buckets)), "_sign": F.lit(sign)})

    return side(source, 1).unionByName(side(table, -1))


def _counts() -> list[Column]:
    return [F.count_if(F.col("_sign") > 0).alias("source_rows"), F.count_if(F.col("_sign") < 0).alias("table_rows")]


def _bucket_counts(both: DataFrame) -> DataFrame:
    drift = F.sum(F.col("_hash").cast("decimal(38,0)") * F.col("_sign"))
    return both.groupBy("_day", "_bucket").agg(*_counts(), (drift != 0).alias("_drift"))


def _rows_that_differ(both: DataFrame, columns: Sequence[str]) -> DataFrame:
    found = _bucket_counts(both).where(F.col("_drift") | (F.col("source_rows") != F.col("table_rows")))
    damaged = found.select(F.col("_day").alias("_damaged_day"), F.col("_bucket").alias("_damaged_bucket"))
    known = damaged.take(BROADCAST_BUCKETS + 1)
    if not known:
        at_fault = both.where(F.lit(False))
    else:
        if len(known) <= BROADCAST_BUCKETS:
            damaged = F.broadcast(both.sparkSession.createDataFrame(known, damaged.schema))
        here = F.col("_day").eqNullSafe(F.col("_damaged_day")) & (F.col("_bucket") == F.col("_damaged_bucket"))
        at_fault = both.join(damaged, here, "left_semi")
    return at_fault.groupBy("_day", *[f"c_{c}" for c in columns]).agg(*_counts()).where("source_rows <> table_rows")


def row_differences(source: DataFrame, table: DataFrame, columns: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """The rows that one feed has more often than the other: the columns, event_date, source_rows, table_rows."""
    rows = _rows_that_differ(_both(source, table, columns, buckets), columns)
    named = [F.col(f"c_{c}").alias(c) for c in columns if c != "event_date"]
    return rows.select(*named, F.col("_day").alias("event_date"), "source_rows", "table_rows")


def day_differences(source: DataFrame, table: DataFrame, columns: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """For each day of either feed: its rows in both, rows that the table lacks, and rows that it has too many."""
    both = _both(source, table, columns, buckets)
    more = F.col("source_rows") - F.col("table_rows")
    zero = F.lit(0).cast("bigint")
    parts = [
        _bucket_counts(both).select("_day", "source_rows", "table_rows", zero.alias("missing"), zero.alias("extra")),
        _rows_that_differ(both, columns).select(
            "_day", zero.alias("source_rows"), zero.alias("table_rows"), F.greatest(more, zero).alias("missing"), F.greatest(-more, zero).alias("extra")
        ),
    ]
    totals = reduce(DataFrame.unionByName, parts).groupBy(F.col("_day").alias("event_date"))
    return totals.agg(*[F.sum(c).alias(c) for c in ("source_rows", "table_rows", "missing", "extra")])
