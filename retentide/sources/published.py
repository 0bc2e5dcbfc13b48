"""Versions of several tables that readers see all at once: immutable copies of partitions, and one pointer.

The batch replaces partitions table by table in its working tables; a reader of those may find new rows in one
table and old ones in another. A publication copies the partitions that have changed since the last one to folders
of their own and writes a manifest of all partitions. The manifest's rename to the next number is the only step
that readers notice; before it they read the version before, whatever has failed or is still running. The copies
cost a second write of what a load has changed, and no other partition is read.

One process publishes at a time; of two, the later one fails. Values of partition columns must be fit for the names of folders, as
days, numbers and words are.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retentide.sources import tables

LOAD = "load_id"
#: One row a partition, and one with the schema for each table.
MANIFEST = "table string, value string, fingerprint string, folder string, schema string"


class Changed(RuntimeError):
    """Tables that changed while they were published, or a version that another process published."""


def _names_in(spark: SparkSession, folder: str) -> list[str]:
    path, fs = tables.hadoop_path(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []


def _delete(spark: SparkSession, folder: str) -> None:
    path, fs = tables.hadoop_path(spark, folder)
    fs.delete(path, True)


def versions(spark: SparkSession, root: str) -> list[int]:
    """The published versions that are still there; the last one is current."""
    return [int(name) for name in _names_in(spark, f"{root}/versions")]


def fingerprints(spark: SparkSession, table: str) -> dict[str, str]:
    """What the files of each partition are; none is opened. A file that is written again has another name."""
    column = tables.partition_column(spark, table)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(tables.location_of(spark, table))
    named = files.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))
    value = F.regexp_extract("file", f"/{column}=([^/]*)/[^/]*$", 1).alias("value")
    mark = F.concat_ws("-", F.count(F.lit(1)), F.bit_xor(F.xxhash64("file", "size"))).alias("mark")
    return {r["value"]: r["mark"] for r in named.groupBy(value).agg(mark).collect()}


@dataclass(frozen=True)
class Version:
    """A version that a reader holds on to: all tables as of one publication, until it is vacuumed."""

    spark: SparkSession
    root: str
    number: int

    @cached_property
    def rows(self) -> list[T.Row]:
        """The manifest; as many rows as the tables have partitions."""
        return self.spark.read.schema(MANIFEST).parquet(f"{self.root}/versions/{self.number:08d}").collect()

    @property
    def tables(self) -> list[str]:
        return sorted(r["table"] for r in self.rows if r["schema"])

    def table(self, name: str) -> DataFrame:
        """A table as it was published."""
        found = next((r["schema"] for r in self.rows if r["table"] == name and r["schema"]), None)
        if found is None:
            raise KeyError(f"version {self.number} has no table {name}")
        schema = T.StructType.fromJson(json.loads(found))
        base = f"{self.root}/data/{name}"
        folders = [f"{self.root}/data/{r['folder']}" for r in self.rows if r["table"] == name and r["folder"]]
        if not folders:
            return self.spark.createDataFrame([], schema)
        stored = T.StructType([*schema.fields, T.StructField(LOAD, T.StringType())])
        return self.spark.read.schema(stored).option("basePath", base).parquet(*folders).select(*schema.fieldNames())


def current(spark: SparkSession, root: str) -> Version | None:
    """The latest version; None before the first publication."""
    held = versions(spark, root)
    return Version(spark, root, held[-1]) if held else None


def publish(spark: SparkSession, names: list[str], root: str) -> Version:
    """Make the tables as they are now the next version."""
    before = current(spark, root)
    number = before.number + 1 if before else 1
    held = {(r["table"], r["value"]): r for r in before.rows if r["folder"]} if before else {}
    now = {name: fingerprints(spark, name) for name in names}
    load, rows = uuid.uuid4().hex, []
    for name, marks in now.items():
        column = tables.partition_column(spark, name)
        rows.append((name, None, None, None, spark.table(name).schema.json()))
        fresh = [v for v, mark in marks.items() if (name, v) not in held or held[name, v]["fingerprint"] != mark]
        if fresh:
            part = spark.table(name).where(F.col(column).cast("string").isin(fresh))
            part.write.partitionBy(column).parquet(f"{root}/data/{name}/{LOAD}={load}")
        for v, mark in marks.items():
            folder = f"{name}/{LOAD}={load}/{column}={v}" if v in fresh else held[name, v]["folder"]
            rows.append((name, v, mark, folder, None))
    if now != {name: fingerprints(spark, name) for name in names}:
        raise Changed("the tables changed while they were published")
    _point(spark, spark.createDataFrame(rows, MANIFEST), root, number)
    return Version(spark, root, number)


def _point(spark: SparkSession, manifest: DataFrame, root: str, number: int) -> None:
    """Put a manifest in place as a version, by one rename."""
    name = uuid.uuid4().hex
    staged, at = f"{root}/staged/{name}", f"{root}/versions/{number:08d}"
    manifest.coalesce(1).write.parquet(staged)
    source, fs = tables.hadoop_path(spark, staged)
    target, _ = tables.hadoop_path(spark, at)
    fs.mkdirs(target.getParent())
    done = not fs.exists(target) and fs.rename(source, target)
    # a version that came up in between takes the renamed folder in as a child
    if not done or name in _names_in(spark, at):
        _delete(spark, f"{at}/{name}")
        raise Changed(f"version {number} has been published by another process")


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete all but the last ``keep`` versions, and the copies that none of these needs, those of broken
    publications included; returns the number of folders deleted. Not to be run beside a publication."""
    if keep < 1:
        raise ValueError("the current version has to stay")
    held = versions(spark, root)
    needed = {r["folder"] for v in held[-keep:] for r in Version(spark, root, v).rows if r["folder"]}
    for v in held[:-keep]:
        _delete(spark, f"{root}/versions/{v:08d}")
    _delete(spark, f"{root}/staged")
    deleted = 0
    for name in _names_in(spark, f"{root}/data"):
        for load in _names_in(spark, f"{root}/data/{name}"):
            copies = {f"{name}/{load}/{v}" for v in _names_in(spark, f"{root}/data/{name}/{load}") if "=" in v}
            unused = copies - needed
            deleted += len(unused)
            for folder in [f"{name}/{load}"] if unused == copies else sorted(unused):
                _delete(spark, f"{root}/data/{folder}")
    return deleted
