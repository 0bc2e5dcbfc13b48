"""Partitioned parquet tables: create, probe, replace days, rebuild.

Tables lie at fixed folders below the warehouse and are registered over them, so that a later
process with a catalog of its own finds what an earlier one wrote; no metastore is needed.

Writes use dynamic overwrite, which puts new files in place when all of them are written: a failed
job leaves the old rows, a repeated job gives the same table, and a job may read other days of the
table it writes. Partitions that get no rows are dropped, as an overwrite would keep them.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import lru_cache

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A folder beside the partitions that readers skip; it holds the number of buckets.
LAYOUT = "_layout"


def table_missing(spark: SparkSession, table: str) -> bool:
    return not spark.catalog.tableExists(table)


@dataclass(frozen=True)
class Buckets:
    """Files of a partition split by the hash of a column, for joins without a shuffle."""

    column: str
    number: int


def location_of(spark: SparkSession, table: str) -> str:
    """The folder of a table: that of its database below the warehouse."""
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    database, _, name = table.rpartition(".")
    return f"{warehouse}/{database}.db/{name}" if database else f"{warehouse}/{name}"


def hadoop_path(spark: SparkSession, location: str):
    """A path with its file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, location: str) -> bool:
    path, fs = hadoop_path(spark, location)
    return fs.exists(path)


def create_table(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    partition_field: str,
    buckets: Buckets | None = None,
) -> bool:
    """Create the table, or register it over the files that an earlier process wrote; False if this
    session has it already. Files that are there keep the buckets they were written with."""
    if not table_missing(spark, table):
        return False
    buckets_of.cache_clear()
    partition_column.cache_clear()
    if "." in table:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.rsplit('.', 1)[0]}")
    location = location_of(spark, table)
    layout = f"{location}/{LAYOUT}"
    if _exists(spark, layout):
        kept = spark.read.schema("bucket_column string, buckets int").json(layout).first()
        buckets = Buckets(*kept) if kept and kept["buckets"] else None
    else:
        kept = [(buckets.column, buckets.number) if buckets else (None, None)]
        spark.createDataFrame(kept, "bucket_column string, buckets int").coalesce(1).write.json(layout)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    clustered = f"CLUSTERED BY (`{buckets.column}`) INTO {buckets.number} BUCKETS" if buckets else ""
    # Dynamic overwrite is an option of the table, so that no write has to change the session.
    spark.sql(
        f"CREATE TABLE {table} ({columns}) USING parquet OPTIONS (partitionOverwriteMode 'dynamic') "
        f"PARTITIONED BY (`{partition_field}`) {clustered} LOCATION '{location}'"
    )
    spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    return True


def create_day_table(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    partition_field: str,
    buckets: Buckets | None = None,
) -> bool:
    """Create the table, partitioned by its date column, unless it exists."""
    if schema[partition_field].dataType != T.DateType():
        raise ValueError(f"{partition_field} has to be a date")
    return create_table(spark, table, schema, partition_field, buckets)


# Both are fixed when a table is created, and asked for by every write.
@lru_cache(maxsize=None)
def buckets_of(spark: SparkSession, table: str) -> Buckets | None:
    bucketed = [c.name for c in spark.catalog.listColumns(table) if c.isBucket]
    if not bucketed:
        return None
    described = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Num Buckets'")
    return Buckets(bucketed[0], int(described.first()["data_type"]))


@lru_cache(maxsize=None)
def partition_column(spark: SparkSession, table: str) -> str:
    return next(c.name for c in spark.catalog.listColumns(table) if c.isPartition)


def _laid_out(df: DataFrame, table: str, *columns: str) -> DataFrame:
    """Rows moved so that the write produces few files of even size."""
    buckets = buckets_of(df.sparkSession, table)
    if buckets:
        return df.repartition(buckets.number, buckets.column)
    return df.hint("rebalance", *columns)


def has_rows(df: DataFrame) -> bool:
    return not df.isEmpty()


def day_partition(
    spark: SparkSession, table: str, day: date, column: str = "event_date"
) -> DataFrame:
    """One day of a table; the filter prunes all other partitions."""
    return spark.table(table).where(F.col(column) == F.lit(day))


def partition_exists(
    spark: SparkSession, table: str, day: date, column: str = "event_date"
) -> bool:
    return has_rows(day_partition(spark, table, day, column))


def partition_row_count(
    spark: SparkSession, table: str, day: date, column: str = "event_date"
) -> int:
    return day_partition(spark, table, day, column).count()


def partition_values(spark: SparkSession, table: str) -> list[str]:
    """The values the table has partitions for, as text, from the catalog: one entry each."""
    rows = spark.sql(f"SHOW PARTITIONS {table}").collect()
    values = [row[0].split("=", 1)[1] for row in rows]
    return sorted(v for v in values if not v.startswith("__"))


def partition_days(spark: SparkSession, table: str) -> list[date]:
    """The days the table has partitions for."""
    return [date.fromisoformat(v) for v in partition_values(spark, table)]


def drop_partition(spark: SparkSession, table: str, value: str) -> None:
    """Take a partition out of the catalog and delete its files."""
    column = partition_column(spark, table)
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (`{column}` = '{value}')")
    path, fs = hadoop_path(spark, f"{location_of(spark, table)}/{column}={value}")
    fs.delete(path, True)


def drop_day(spark: SparkSession, table: str, day: date) -> None:
    drop_partition(spark, table, str(day))


def _overwrite(df: DataFrame, table: str) -> set[str]:
    """Replace the partitions that ``df`` has rows for; returns their values as text."""
    spark = df.sparkSession
    column = partition_column(spark, table)
    written = Observation()
    rows = df.observe(written, F.collect_set(F.col(column).cast("string")).alias("found"))
    rows.write.insertInto(table, overwrite=True)
    return set(written.get["found"])


def replace_day(
    df: DataFrame, table: str, day: date, column: str = "event_date", laid_out: bool = False
) -> int:
    """Replace one day of the table with the rows of ``df`` for that day; returns their number.

    The rows are rebalanced first, so the partition gets files of even size, however many
    tasks found rows of the day. ``laid_out`` skips that for rows that are in place already.
    """
    spark = df.sparkSession
    counted = Observation()
    rows = df.where(F.col(column) == F.lit(day)).select(*spark.table(table).columns)
    rows = rows if laid_out else _laid_out(rows, table)
    _overwrite(rows.observe(counted, F.count(F.lit(1)).alias("n")), table)
    n = counted.get["n"]
    if n == 0:
        drop_day(spark, table, day)
    return n


def replace_days(
    df: DataFrame,
    table: str,
    first: date,
    last: date,
    column: str = "event_date",
    laid_out: bool = False,
) -> None:
    """Replace all days from ``first`` to ``last`` in one write; days without rows are dropped."""
    replace_where(df, table, F.col(column).between(F.lit(first), F.lit(last)), lambda v: first <= date.fromisoformat(v) <= last, laid_out)


def replace_where(df: DataFrame, table: str, rows_of: Column, is_part, laid_out: bool = False) -> None:
    """Replace the partitions whose value ``is_part`` accepts by the rows that ``rows_of`` picks."""
    spark = df.sparkSession
    rows = df.where(rows_of).select(*spark.table(table).columns)
    rows = rows if laid_out else _laid_out(rows, table, partition_column(spark, table))
    before = {v for v in partition_values(spark, table) if is_part(v)}
    found = _overwrite(rows, table)
    for value in sorted(before - found):
        drop_partition(spark, table, value)


def rebuild(df: DataFrame, table: str) -> None:
    """Replace the whole table; an empty ``df`` empties it.

    New partitions are put in place when all are written, and those that are no longer produced are
    dropped after that, so a job that fails while it writes leaves the old rows.
    """
    replace_where(df, table, F.lit(True), lambda v: True)


def rebuild_small(df: DataFrame, table: str) -> None:
    """The same for a table with a few rows a day, which one task writes."""
    replace_where(df.coalesce(1), table, F.lit(True), lambda v: True, laid_out=True)
