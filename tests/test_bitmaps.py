"""The daily bitmap step, its closed form, and the conversion to integers."""

from helpers import day, event, events
from pyspark.sql import functions as F

from retentide.functions.bitmaps import active_days_in, bitmap_to_words
from retentide.operators import bitmaps
from retentide.schemas import LOGIN_BITMAPS


def feed(spark):
    rows = [event(n, platform=p) for n in (0, 1) for p in ("android", "web")]
    return events(spark, rows + [event(2, platform="ios")])


def empty(spark):
    return spark.createDataFrame([], LOGIN_BITMAPS)


def steps(spark, source, last, key):
    """One table of rows per day, each step reading the one before it."""
    prev, out = empty(spark), []
    for n in range(last + 1):
        rows = bitmaps.carry_forward(prev, source, day(n), key).collect()
        prev = spark.createDataFrame(rows, LOGIN_BITMAPS)
        out.append(rows)
    return out


def short(rows):
    return sorted((r.device, r.login_bitmap, r.isNew) for r in rows)


def test_device_key_golden(spark):
    zero, one, two = steps(spark, feed(spark), 2, "device")
    assert short(zero) == [("android_u_0001", "1", "1"), ("web_u_0001", "1", "1")]
    assert short(one) == [("android_u_0001", "11", "0"), ("web_u_0001", "11", "0")]
    assert short(two) == [
        ("android_u_0001", "110", "0"), ("ios_u_0001", "1", "1"), ("web_u_0001", "110", "0")
    ]
    assert {r.device: r.reg_date for r in two}["ios_u_0001"] == day(2)


def test_user_key_golden_with_fan_out(spark):
    zero, one, two = steps(spark, feed(spark), 2, "user_id")
    assert short(zero) == [("android_u_0001", "1", "1"), ("web_u_0001", "1", "1")]
    assert short(one) == [("android_u_0001", "11", "0")] * 2 + [("web_u_0001", "11", "0")] * 2
    assert short(two) == [("android_u_0001", "111", "0")] * 2 + [("web_u_0001", "111", "0")] * 2


def test_closed_form_equals_daily_steps(spark):
    rows = [
        event(n, user=f"u_{u:04d}", platform=("android", "ios", "web")[(u + n) % 3],
              hour=(u * n) % 24, country=("MY", "PH", "SG")[(u * 7 + n) % 3])
        for u in range(12) for n in range(10) if (u * 5 + n * n) % 4 < 2
    ]
    rows += [event(4, user=None)]
    source = events(spark, rows).cache()
    by_step = {tuple(r) for part in steps(spark, source, 11, "device") for r in part}
    built = bitmaps.build_bitmaps(source, day(11))
    assert {tuple(r) for r in built.collect()} == by_step
    later = bitmaps.build_bitmaps(source, day(11), from_day=day(8))
    assert {tuple(r) for r in later.collect()} == {r for r in by_step if r[0] >= day(8)}
    assert built.where(
        F.length("login_bitmap") != F.datediff("event_date", "reg_date") + 1
    ).isEmpty()


def test_attributes_of_the_first_event_win(spark):
    source = events(
        spark,
        [event(0, hour=9, country="PH"), event(0, hour=8, country="TH"), event(1, country="ID")],
    )
    by_step = steps(spark, source, 1, "device")
    assert [r.country for part in by_step for r in part] == ["TH", "TH"]
    assert {r.country for r in bitmaps.build_bitmaps(source, day(1)).collect()} == {"TH"}


def test_activity_comes_back_from_the_last_day(spark):
    source = events(spark, [event(n, platform=p) for n, p in [(0, "web"), (3, "ios"), (3, "web"), (70, "web")]])
    last = bitmaps.build_bitmaps(source, day(72), from_day=day(72))
    got = {(r.user_id, r.event_date) for r in bitmaps.activity_of(last).collect()}
    assert got == {("u_0001", day(n)) for n in (0, 3, 70)}


def test_words_hold_the_whole_bitmap(spark):
    maps = ["1", "10", "0011", "1" * 63, "1" * 80, "1" + "0" * 70, "10" * 100, ""]
    df = spark.createDataFrame([(b,) for b in maps], "b string")
    got = [r[0] for r in df.select(bitmap_to_words(F.col("b"))).collect()]
    for b, words in zip(maps, got, strict=True):
        assert sum((w or 0) << (63 * k) for k, w in enumerate(words)) == int(b or "0", 2), b
    for window, skip in [(1, 0), (14, 14), (63, 0), (60, 10), (90, 90), (5, 63)]:
        counts = [r[0] for r in df.select(active_days_in(bitmap_to_words(F.col("b")), window, skip)).collect()]
        assert counts == [b[::-1][skip : skip + window].count("1") for b in maps], (window, skip)


def test_histories_extended_by_new_days_equal_those_of_all_events(spark):
    rows = [
        event(n, user=f"u_{u:04d}", platform=("android", "ios")[(u + n) % 2], country=("MY", "SG")[(u + n) % 2])
        for u in range(9) for n in range(12) if (u * 5 + n * n) % 4 < 2 and (u != 8 or n > 8)
    ]
    source = events(spark, rows).cache()
    whole = {tuple(r) for r in bitmaps.build_bitmaps(source, day(14), from_day=day(6)).collect()}
    prev = bitmaps.build_bitmaps(source, day(5), from_day=day(5))
    late = source.where(F.col("event_date") >= F.lit(day(6)))
    for buckets in (None, 3):
        built = bitmaps.build_bitmaps(late, day(14), day(6), buckets, prev)
        assert {tuple(r) for r in built.collect()} == whole
    first = bitmaps.build_bitmaps(source, day(14), day(0), None, empty(spark))
    assert {tuple(r) for r in first.collect()} == {tuple(r) for r in bitmaps.build_bitmaps(source, day(14)).collect()}


def test_words_compute_the_bitmap_once(spark):
    # a bitmap that is named inside the loop over words is computed again, and walked from its start, for each word
    df = spark.createDataFrame([("1" * 80,)], "b string")
    words = df.select(bitmap_to_words(F.reverse("b")).alias("words"))
    plan = words._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("reverse(") == 1
    assert [r[0] for r in words.collect()] == [[2**63 - 1, 2**17 - 1]]
