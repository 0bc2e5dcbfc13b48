"""Raw logs with line breaks inside quotes, read by many tasks a file.

Spark splits a CSV file at line ends, or reads it in one task. Whether a line end lies inside quotes depends
on how many quotes come before it in the file, which splits can be told by a prefix sum over their counts.
Records are then put together from the lines between two true ends.

Quotes are those of RFC 4180: around whole values, doubled inside. A file with an odd number of quotes fails.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from retentide.schemas import EVENTS
from retentide.session import require_utc
from retentide.sources.raw_events import DIALECT, list_files, path_of, read_raw_events


def read_quoted_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The events of a log whose values may hold line breaks; like ``read_raw_events`` otherwise.

    One pass counts quotes. Files without a line break inside quotes are then read as they are; the lines of
    the others are shuffled once, by split. A line break inside a value comes out as it is in the file, and
    an empty log has no events.
    """
    counts = _lines(require_utc(spark), path).groupBy("file").agg(
        F.count_if(_odd(F.col("quotes"))).alias("odd"), F.sum("quotes").alias("quotes")
    )
    broken = {r["file"]: r["quotes"] for r in counts.where("odd > 0").collect()}
    unclosed = [file for file, quotes in broken.items() if quotes % 2]
    if unclosed:
        raise ValueError(f"quotes that aren't closed: {unclosed}")
    parts = []
    if broken:
        parts.append(_parsed(records(_lines(spark, [path_of(f) for f in broken]))))
    whole = [r["file"] for r in list_files(spark, path).collect() if r["file"] not in broken]
    if whole or not parts:
        parts.append(read_raw_events(spark, [path_of(f) for f in whole]) if whole else spark.createDataFrame([], EVENTS))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _odd(number: Column) -> Column:
    return number % 2 == 1


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Each line with its split, its place in the split, and its number of quotes."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit(DIALECT["quote"]), F.lit("")))
    return spark.read.option("lineSep", "\n").text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        # only its order within a split is used
        F.monotonically_increasing_id().alias("place"),
        quotes.cast("bigint").alias("quotes"),
    )


def records(lines: DataFrame) -> DataFrame:
    """(file, number, record) of the lines of some files; blank lines between records are left out.

    A split's lines are numbered without knowing how the split begins: ``first_0`` and ``first_1`` count the
    records that begin in it if an even or odd number of quotes comes before it. The sums over the splits of a
    file, a row each, choose between them. Only records of several lines are then grouped, by record.
    """
    in_split = W.partitionBy("file", "block").orderBy("place").rowsBetween(W.unboundedPreceding, W.currentRow)
    before = F.sum("quotes").over(in_split) - F.col("quotes")
    blank = F.trim(F.regexp_replace("value", "\r$", "")) == ""
    marked = lines.withColumn("inside", _odd(before)).withColumn("blank", blank)
    numbered = marked.select(
        "*",
        F.count_if(~F.col("inside") & ~F.col("blank")).over(in_split).alias("first_0"),
        F.count_if(F.col("inside") & ~F.col("blank")).over(in_split).alias("first_1"),
    )
    splits = numbered.groupBy("file", "block").agg(F.sum("quotes").alias("quotes"), F.max("first_0").alias("first_0"), F.max("first_1").alias("first_1"))
    earlier = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    opened = splits.withColumn("opens_inside", F.coalesce(_odd(F.sum("quotes").over(earlier)), F.lit(False)))
    begun = F.when(F.col("opens_inside"), F.col("first_1")).otherwise(F.col("first_0"))
    offsets = opened.select("file", "block", "opens_inside", F.coalesce(F.sum(begun).over(earlier), F.lit(0)).alias("offset"))
    placed = numbered.join(offsets, ["file", "block"]).select(
        "file", "block", "place", "value", "quotes", "blank",
        (F.col("inside") != F.col("opens_inside")).alias("inside"),
        (F.col("offset") + F.when(F.col("opens_inside"), F.col("first_1")).otherwise(F.col("first_0"))).alias("number"),
    )
    alone = ~F.col("inside") & ~_odd(F.col("quotes"))
    single = placed.where(alone & ~F.col("blank")).select("file", "number", F.col("value").alias("record"))
    parts = F.array_sort(F.collect_list(F.struct("block", "place", "value")))
    several = placed.where(~alone).groupBy("file", "number").agg(F.array_join(F.transform(parts, lambda p: p["value"]), "\n").alias("record"))
    return single.unionByName(several).withColumn("record", F.regexp_replace("record", "\r$", ""))


def _parsed(found: DataFrame) -> DataFrame:
    """The events of records; the first record of a file has to be the header."""
    header = F.lower(F.regexp_replace("record", '"', "")) == ",".join(EVENTS.fieldNames()).lower()
    checked = F.when(F.col("number") > 1, True).when(header, False).otherwise(
        F.raise_error(F.concat(F.lit("not the header of the raw log: "), F.col("record"))).cast("boolean")
    )
    options = {**DIALECT, "mode": "FAILFAST", "multiLine": True} | {"header": False}
    as_text = {k: str(v).lower() if isinstance(v, bool) else v for k, v in options.items()}
    events = found.where(checked).select(F.from_csv("record", EVENTS.simpleString()[len("struct<"):-1].replace(":", " "), as_text).alias("event"))
    return events.select("event.*")
