"""Reconciliation by content: fingerprints first, rows only where they differ."""

import random
from collections import Counter

import pytest
from helpers import day, event, events
from pyspark.sql import functions as F

from retentide.operators import reconcile
from retentide.plans import jobs
from retentide.schemas import EVENTS
from retentide.sources import tables
from test_jobs import log, names, write_raw  # noqa: F401

COLUMNS = EVENTS.fieldNames()
T = "event_date date, a string, b string, n long"


def feed(spark, rows):
    return spark.createDataFrame(rows, T)


def found(source, table, buckets=4):
    rows = reconcile.row_differences(source, table, ["a", "b", "n"], buckets).collect()
    return {(r.event_date, r.a, r.b, r.n): (r.source_rows, r.table_rows) for r in rows}


def test_a_value_that_moves_to_another_column_is_found(spark):
    source = feed(spark, [(day(0), "x", None, 1), (day(0), "y", "z", 1)])
    table = feed(spark, [(day(0), None, "x", 1), (day(0), "y", "z", 1)])
    assert found(source, table) == {(day(0), "x", None, 1): (1, 0), (day(0), None, "x", 1): (0, 1)}


def test_swapped_repeated_and_misplaced_rows_with_equal_counts(spark):
    source = feed(spark, [(day(0), "x", "p", 1), (day(0), "y", "q", 2), (day(1), "x", "p", 1), (None, "x", "p", 1)])
    table = feed(spark, [(day(0), "x", "q", 1), (day(0), "y", "p", 2), (day(1), "x", "p", 1), (None, "x", "p", 2)])
    assert found(source, table) == {
        (day(0), "x", "p", 1): (1, 0), (day(0), "y", "q", 2): (1, 0), (day(0), "x", "q", 1): (0, 1), (day(0), "y", "p", 2): (0, 1),
        (None, "x", "p", 1): (1, 0), (None, "x", "p", 2): (0, 1),
    }
    days = {r.event_date: tuple(r)[1:] for r in reconcile.day_differences(source, table, ["a", "b", "n"]).collect()}
    assert days == {day(0): (2, 2, 2, 2), day(1): (1, 1, 0, 0), None: (1, 1, 1, 1)}


def test_empty_feeds_and_columns_of_other_names(spark):
    rows = feed(spark, [(day(0), "x", "p", 1)] * 3)
    assert found(rows, rows) == {} and found(rows.limit(0), rows.limit(0)) == {}
    assert reconcile.day_differences(rows.limit(0), rows.limit(0), ["a"]).collect() == []
    clashing = rows.withColumns({"_hash": F.lit("no"), "_sign": F.lit(7), "source_rows": F.lit(1), "_bucket": F.lit(None)})
    assert found(clashing, rows.limit(0)) == {(day(0), "x", "p", 1): (3, 0)}


@pytest.mark.parametrize("seed, bound", [(1, 100_000), (2, 3)])
def test_differences_equal_counting(spark, monkeypatch, seed, bound):
    monkeypatch.setattr(reconcile, "BROADCAST_BUCKETS", bound)
    draw = random.Random(seed)
    value = lambda: draw.choice([None, "", "x", "y", "é"])
    rows = [(day(draw.randrange(3)), value(), value(), draw.choice([None, 0, 1])) for _ in range(300)]
    other = [r for r in rows if draw.random() > 0.05] + draw.sample(rows, 10) + [(day(4), "x", "x", 1)]
    a, b = Counter(rows), Counter(other)
    assert found(feed(spark, rows), feed(spark, other)) == {k: (a[k], b[k]) for k in a | b if a[k] != b[k]}


def test_only_damaged_buckets_are_compared(spark):
    rows = spark.range(2000).select(F.lit(day(0)).alias("event_date"), F.col("id").cast("string").alias("a"), F.lit("p").alias("b"), F.col("id").alias("n"))
    both = reconcile._both(rows, rows.withColumn("b", F.when(F.col("n") == 5, "q").otherwise("p")), ["a", "b", "n"], 256)
    counted = reconcile._bucket_counts(both).collect()
    assert sum(r._drift for r in counted) == 2 and all(r.source_rows < 40 for r in counted)


def test_bronze_against_its_log(spark, tmp_path, names):  # noqa: F811
    raw = write_raw(spark, tmp_path, log(2))
    jobs.backfill(spark, raw, day(0), day(2), names, metrics=False)
    assert not [r for r in jobs.reconcile_bronze(spark, raw, day(0), day(2), names).collect() if r.missing or r.extra]
    damaged = spark.table(names.events).withColumn("country", F.when(F.hour("event_time") == 13, "MY").otherwise(F.col("country")))
    damaged = damaged.where(F.col("event_date") == F.lit(day(1)))
    n = damaged.where("country = 'MY'").count()
    tables.replace_day(spark.createDataFrame(damaged.collect(), damaged.schema), names.events, day(1))
    days = {r.event_date: (r.missing, r.extra) for r in jobs.reconcile_bronze(spark, raw, day(0), day(2), names).collect()}
    assert n and days == {day(0): (0, 0), day(1): (n, n), day(2): (0, 0)}


def test_events_have_the_fingerprint_of_their_rows(spark):
    rows = events(spark, [event(0), event(0, user="u_0002"), event(0)])
    mark = lambda df: df.agg(reconcile.fingerprint(COLUMNS)).first()[0]
    assert mark(rows) == mark(rows.orderBy("user_id")) != mark(rows.distinct())
