"""Held-out splits, and bounded samples of labelled rows for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_part(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo `parts`; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def cut_by_hash(df: DataFrame, key: Column, rows: int, total: int) -> DataFrame:
    """About, and at most, `rows` of the `total` rows of `df`: those of the least hash `key` (a long).

    A range of the hash is cut out first, so that no task sends many more rows than its share to the one that
    sorts them. Where many rows have one hash, fewer come out."""
    share = min(1.0, (rows + 4 * rows**0.5 + 16) / max(total, 1))
    least = df.withColumn("__key", key).where(F.shiftrightunsigned("__key", 33) < int(share * (1 << 31)))
    return least.orderBy("__key").limit(rows).drop("__key")


def labelled_sample(labels: DataFrame, label: str, parts: int, held_out: int, rows: int) -> DataFrame:
    """(doc_id, label) of at most `rows` labelled documents outside the held-out part, picked by a hash
    of the id. Of several labels of one document the greatest counts; NULL labels and ids don't."""
    kept = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).dropna()
    kept = kept.where(split_part(F.col("doc_id"), parts) != held_out).groupBy("doc_id").agg(F.max("label").alias("label"))
    return kept.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
