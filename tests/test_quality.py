"""Every check passes on clean rows and finds injected bad ones."""

import pytest
from helpers import day, event, events
from pyspark.sql import functions as F

from retentide.operators import bitmaps, quality

CLEAN = [event(0, kind="miles_earned"), event(0, kind="like"), event(0, kind="reward_search")]


def report(df):
    return {r.check: r.n_bad for r in df.collect()}


def test_clean_events_pass(spark):
    assert set(report(quality.event_assertions(events(spark, CLEAN))).values()) == {0}


@pytest.mark.parametrize(
    "check, bad",
    [
        ("event_time_not_null", [event(None)]),
        ("user_id_format", [event(0, user="user-1"), event(0, user=None)]),
        ("event_type_known", [event(0, kind="login"), event(0, event_type=None)]),
        (
            "miles_amount_positive",
            [event(0, kind="miles_earned", miles_amount=0.0),
             event(0, kind="miles_earned", miles_amount=None)],
        ),
        ("miles_amount_absent", [event(0, kind="like", miles_amount=1.0)]),
        ("country_known", [event(0, country="US"), event(0, country=None)]),
        ("gender_known", [event(0, gender="?")]),
        ("platform_known", [event(0, platform="tv")]),
        ("utm_source_known", [event(0, utm_source="")]),
    ],
)
def test_bad_events_are_found(spark, check, bad):
    found = report(quality.event_assertions(events(spark, CLEAN + bad)))
    assert {c: n for c, n in found.items() if n} == {check: len(bad)}


def bitmap_rows(spark):
    feed = events(spark, [event(0), event(0, platform="web"), event(1), event(1, user="u_0002")])
    return bitmaps.build_bitmaps(feed, day(1)), bitmaps.active_devices(feed)


def test_clean_bitmaps_pass(spark):
    table, active = bitmap_rows(spark)
    assert set(report(quality.bitmap_checks(table, active)).values()) == {0}
    assert set(report(quality.bitmap_row_checks(table)).values()) == {0}


@pytest.mark.parametrize(
    "check, change",
    [
        ("active_device_present", lambda t: t.where("not (device = 'android_u_0001' and event_date = '2025-02-07')")),
        ("device_format", lambda t: t.withColumn("device", F.when(F.col("login_bitmap") == "10", "webu0001").otherwise(F.col("device")))),
        ("active_bitmap_ends_1", lambda t: t.withColumn("login_bitmap", F.regexp_replace("login_bitmap", "^11$", "10"))),
        ("inactive_bitmap_ends_0", lambda t: t.withColumn("login_bitmap", F.regexp_replace("login_bitmap", "^10$", "11"))),
        ("new_device_has_single_login", lambda t: t.withColumn("login_bitmap", F.when(F.col("user_id") == "u_0002", "01").otherwise(F.col("login_bitmap")))),
        ("device_not_null", lambda t: t.withColumn("device", F.when(F.col("login_bitmap") != "10", F.col("device")))),
    ],
)
def test_bad_bitmaps_are_found(spark, check, change):
    table, active = bitmap_rows(spark)
    found = report(quality.bitmap_checks(change(table), active))
    assert {c: n for c, n in found.items() if n} == {check: 1}


def test_new_device_without_events_is_found(spark):
    table, active = bitmap_rows(spark)
    quiet = active.where("user_id != 'u_0002'")
    found = report(quality.bitmap_checks(table, quiet))
    assert found["new_device_is_active"] == 1
    assert [r.device for r in quality.new_without_activity(table, quiet).collect()] == ["android_u_0002"]
    assert [r.device for r in quality.login_without_activity(table, quiet).collect()] == ["android_u_0002"]


def test_lists_of_bad_devices(spark):
    table, active = bitmap_rows(spark)
    without = table.where("platform != 'web'")
    assert [r.device for r in quality.missing_devices(without, active).collect()] == ["web_u_0001"]
    off = table.withColumn("login_bitmap", F.regexp_replace("login_bitmap", "^11$", "10"))
    assert [r.device for r in quality.active_without_login(off, active).collect()] == ["android_u_0001"]


def test_row_counts_and_empty_days(spark):
    feed = events(spark, [event(0), event(0, hour=13), event(2)])
    dropped = feed.where("hour(event_time) != 13")
    rows = {r.event_date: r.matches for r in quality.row_count_differences(feed, dropped).collect()}
    assert rows == {day(0): False, day(2): True}
    assert report(quality.empty_days(feed, day(0), day(3), "not_empty")) == {"not_empty": 2}
    assert report(quality.empty_days(feed.limit(0), day(0), day(3), "not_empty")) == {"not_empty": 4}
