"""The raw event log: CSV files with a header, one event per record, quotes doubled inside quotes."""

from __future__ import annotations

import re
from datetime import date, timedelta
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retentide.schemas import EVENTS
from retentide.session import require_utc

# Quoting as in RFC 4180; blanks belong to a value.
DIALECT = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def read_raw_events(spark: SparkSession, path: str | list[str], multiline: bool = False) -> DataFrame:
    """Typed scan of the raw CSV; a bad record or a differing header fails the load.

    Every column of a record is checked, also when a query reads only some. A line break inside quotes
    fails as well, as files are split at line ends; ``multiline`` reads such files, each in one task, and
    ``quoted_lines.read_quoted_lines`` in many.
    """
    return (
        require_utc(spark)
        .read.schema(EVENTS)
        .options(**DIALECT, enforceSchema=False, mode="FAILFAST", columnPruning=False, multiLine=multiline)
        .csv(path)
    )


def write_raw_events(events: DataFrame, path: str) -> None:
    """Write events in the raw log's CSV form, timestamps with microseconds and the UTC offset."""
    (
        events.select(*EVENTS.fieldNames())
        .write.options(**DIALECT, timestampFormat="yyyy-MM-dd HH:mm:ss.SSSSSSXXX")
        .csv(path)
    )


def paths_of_days(path: str, first: date, last: date | None = None) -> str | list[str]:
    """The files to read for some days. A path with ``{day}`` has a part for each day, as YYYY-MM-DD,
    and only those of the days are read; any other path is one log for all days."""
    if "{day}" not in path:
        return path
    n = ((last or first) - first).days + 1
    return [path.replace("{day}", str(first + timedelta(days=k))) for k in range(n)]


# The index of a log's files

FILE_KEY = ("file", "size", "modified")


def list_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, size, modified) of a log's files; none is opened."""
    return spark.read.format("binaryFile").load(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )


def path_of(file: str) -> str:
    """The path to read a file by. Names come encoded as in a URL, and may hold what a reader takes for a pattern."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", unquote(file))


def index_files(spark: SparkSession, files: DataFrame) -> DataFrame:
    """The files of :func:`list_files` with their least and greatest ``event_time``, in one pass over them.

    A file without events has NULL times. Events without a time are counted.
    """
    names = [r["file"] for r in files.collect()]
    if not names:
        events = spark.createDataFrame([], EVENTS).withColumn("file", F.lit(""))
    else:
        events = read_files(spark, names).select("event_time", F.col("_metadata.file_path").alias("file"))
    times = events.groupBy("file").agg(
        F.min("event_time").alias("first_time"), F.max("event_time").alias("last_time"), F.count_if(F.col("event_time").isNull()).alias("n_without_time")
    )
    return files.join(times, "file", "left").fillna(0, ["n_without_time"])


def files_of_days(index: DataFrame, first: date, last: date | None = None) -> list[str]:
    """The files that may hold events of some days, or events without a time, which belong to none."""
    touches = (F.col("first_time") < _start_of((last or first) + timedelta(days=1))) & (F.col("last_time") >= _start_of(first))
    return [r["file"] for r in index.where(touches | (F.col("n_without_time") > 0)).select("file").collect()]


def read_files(spark: SparkSession, files: list[str]) -> DataFrame:
    """Typed scan of files by the names that :func:`list_files` gives, which may be none."""
    return read_raw_events(spark, [path_of(f) for f in files]) if files else spark.createDataFrame([], EVENTS)


def _start_of(day: date) -> Column:
    return F.lit(f"{day} 00:00:00").cast("timestamp")


def is_on(first: date, last: date | None = None) -> Column:
    """Whether an event is on the UTC day ``first``, or on one from ``first`` to ``last``.

    The half-open range on the timestamp itself reaches the scan as a filter, which a
    cast to a date does not.
    """
    after = (last or first) + timedelta(days=1)
    return (F.col("event_time") >= _start_of(first)) & (F.col("event_time") < _start_of(after))


def day_slice(events: DataFrame, first: date, last: date | None = None) -> DataFrame:
    return events.where(is_on(first, last))


def with_event_date(events: DataFrame) -> DataFrame:
    """Add the UTC day as the last column, where the partitioned table has it."""
    return events.withColumn("event_date", F.to_date("event_time"))
