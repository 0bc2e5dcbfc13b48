"""Versions of all tables: what readers see while a load runs, breaks, or is published."""

import pytest
from helpers import day, event
from pyspark.sql import functions as F
from test_jobs import names, table_rows, write_raw  # noqa: F401

from retentide.plans import jobs
from retentide.sources import published, tables

KINDS = ("miles_earned", "miles_redeemed", "like")


def shown(spark, names):  # noqa: F811
    version = jobs.published_tables(spark, names)
    return {t: sorted(map(tuple, version.table(t).collect()), key=str) for t in version.tables}


def working(spark, names):  # noqa: F811
    return {t: table_rows(spark, t) for t in sorted(names.for_readers)}


def raw_log(spark, tmp_path, days=4):
    rows = [event(n % days, user=f"u_{n % 5:04d}", kind=KINDS[n % 3], hour=n % 24) for n in range(40)]
    return write_raw(spark, tmp_path, rows)


def broken(*_args, **_kwargs):
    raise RuntimeError("killed")


def test_a_load_that_is_killed_between_tables_isnt_seen(spark, tmp_path, names, monkeypatch):  # noqa: F811
    raw = raw_log(spark, tmp_path)
    jobs.backfill(spark, raw, day(0), day(1), names)
    assert jobs.published_tables(spark, names) is None
    assert jobs.publish(spark, names).number == 1
    old = shown(spark, names)
    assert old == working(spark, names)
    held = jobs.published_tables(spark, names)
    for module, step in ((jobs, "clean_days"), (jobs, "step_activity_days"), (jobs.snapshot, "close_ranges"), (jobs, "_step_metrics"), (jobs, "_rolling")):
        with monkeypatch.context() as patched:
            patched.setattr(module, step, broken)
            with pytest.raises(RuntimeError, match="killed"):
                jobs.run_day(spark, raw, day(2), names)
                jobs.rebuild_metrics(spark, day(2), names)
        assert working(spark, names) != old and shown(spark, names) == old
        with pytest.raises(jobs.Unsettled):
            jobs.publish(spark, names)
    jobs.run_day(spark, raw, day(2), names)
    assert shown(spark, names) == old
    # killed while it is published
    with monkeypatch.context() as patched:
        patched.setattr(published, "_point", broken)
        with pytest.raises(RuntimeError, match="killed"):
            jobs.publish(spark, names)
    assert shown(spark, names) == old
    assert jobs.publish(spark, names).number == 2
    assert shown(spark, names) == working(spark, names) != old
    # a reader that holds the old version goes on with it
    assert {t: sorted(map(tuple, held.table(t).collect()), key=str) for t in held.tables} == old


def test_only_partitions_that_changed_are_copied(spark, tmp_path, names):  # noqa: F811
    raw = raw_log(spark, tmp_path)
    jobs.backfill(spark, raw, day(0), day(2), names)
    first = jobs.publish(spark, names)
    jobs.run_day(spark, raw, day(3), names)
    second = jobs.publish(spark, names)
    folders = [{(r["table"], r["value"]): r["folder"] for r in v.rows if r["folder"]} for v in (first, second)]
    fresh = {key for key, folder in folders[1].items() if folders[0].get(key) != folder}
    assert {v for t, v in fresh if t in (names.events, names.bitmaps, names.activity, names.balance, names.ledger)} == {str(day(3))}
    third = jobs.publish(spark, names)
    assert {(r["table"], r["value"]): r["folder"] for r in third.rows if r["folder"]} == folders[1]
    # copies that no version needs, those of a broken publication included
    root = jobs.published_root(spark, names)
    spark.range(3).withColumn("event_date", F.lit("x")).write.partitionBy("event_date").parquet(f"{root}/data/{names.events}/load_id=broken")
    assert published.vacuum(spark, root, keep=1) == 1 + len(set(folders[0].values()) - set(folders[1].values()))
    assert published.versions(spark, root) == [3]
    assert shown(spark, names) == working(spark, names)
    with pytest.raises(ValueError):
        published.vacuum(spark, root, keep=0)


def test_tables_that_change_or_come_first_stop_a_publication(spark, tmp_path, names, monkeypatch):  # noqa: F811
    raw = raw_log(spark, tmp_path, days=2)
    jobs.backfill(spark, raw, day(0), day(1), names)
    root = jobs.published_root(spark, names)
    real = published._point

    def overtaken(spark, manifest, root, number):
        real(spark, manifest, root, number)
        real(spark, manifest, root, number)

    with monkeypatch.context() as patched:
        patched.setattr(published, "_point", overtaken)
        with pytest.raises(published.Changed):
            jobs.publish(spark, names)
    assert published.versions(spark, root) == [1] and shown(spark, names) == working(spark, names)
    looks = []

    def changing(spark, table, look=published.fingerprints):
        looks.append(table)
        return {**look(spark, table), **({"new": "1-1"} if len(looks) > len(names.for_readers) else {})}

    with monkeypatch.context() as patched:
        patched.setattr(published, "fingerprints", changing)
        with pytest.raises(published.Changed):
            jobs.publish(spark, names)
    assert published.versions(spark, root) == [1]


def test_partitions_that_go_and_tables_without_rows(spark, tmp_path, names):  # noqa: F811
    jobs.create_tables(spark, names)
    root = jobs.published_root(spark, names)
    with pytest.raises(jobs.Unsettled):
        jobs.publish(spark, names)
    version = published.publish(spark, [names.events], root)
    assert version.table(names.events).collect() == [] and version.table(names.events).schema == spark.table(names.events).schema
    with pytest.raises(KeyError):
        version.table(names.states)
    raw = raw_log(spark, tmp_path, days=2)
    for n in (0, 1):
        jobs.load_bronze(spark, raw, day(n), names)
    assert published.publish(spark, [names.events], root).table(names.events).count() == 40
    tables.drop_day(spark, names.events, day(0))
    assert published.publish(spark, [names.events], root).table(names.events).count() == 20
    assert published.Version(spark, root, 2).table(names.events).count() == 40
