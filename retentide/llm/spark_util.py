"""Checkpoints in the shared folder, and bitmaps of a fixed size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir or, where that is missing, one below the
    warehouse, which is shared too."""
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    return spark.conf.get("spark.checkpoint.dir", f"{warehouse}/_checkpoints").rstrip("/")


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage by a reliable checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


#: Rows that go to a Python worker at once; the default of 10,000 whole texts takes tens of megabytes on both sides.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session, unless it has smaller ones."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = int(spark.conf.get(setting))
    if not 0 < rows <= BATCH_ROWS:
        spark.conf.set(setting, str(BATCH_ROWS))


def bitmap(spark: SparkSession, keys: DataFrame, key: Column, bits: int) -> Broadcast:
    """Broadcast a bitmap of 2**bits places, whatever the number of keys: `key` hashes of `keys`,
    by their upper bits. At most 2**bits / 64 words come to the driver."""
    place = F.shiftrightunsigned(key, 64 - bits)
    one = F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))
    found = keys.select((place / 64).cast("int").alias("word"), one.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    table = np.zeros(1 << (bits - 6), np.int64)
    table[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return spark.sparkContext.broadcast(table.view(np.uint64))


#: A bitmap has so many places for each key, within these bounds, as powers of two.
PLACES_PER_KEY, BITMAP_BITS = 5, (16, 26)


def bitmap_of(keys: DataFrame, key: str) -> Broadcast:
    """A bitmap whose size goes with the number of keys, up to eight megabytes."""
    low, high = BITMAP_BITS
    return bitmap(keys.sparkSession, keys, F.col(key), min(high, max(low, keys.count().bit_length() + PLACES_PER_KEY)))


def flag_keys(rows: DataFrame, key: str, flags: dict[str, DataFrame]) -> DataFrame:
    """`rows` with a boolean column for each of `flags`, false only where its keys (a column `key`) don't have the row's `key`,
    a hash that isn't NULL."""
    names, wanted = list(flags), [bitmap_of(keys, key) for keys in flags.values()]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column(key).to_numpy().view(np.uint64)
            found = [pa.array(in_bitmap(w.value, hashes), pa.bool_()) for w in wanted]
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], [*batch.schema.names, *names])

    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema] + [f"`{name}` boolean" for name in names]
    return rows.mapInArrow(scan, ", ".join(columns))


def in_bitmap(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the uint64 hashes may be among the keys; a key is never missed."""
    bits = len(table).bit_length() - 1 + 6
    place = hashes >> np.uint64(64 - bits)
    return (table[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1
