"""The raw log: line breaks inside quotes read by many tasks, and the index of its files."""

import random
from urllib.parse import unquote

import pytest
from helpers import day, event, events
from pyspark.sql import functions as F
from test_jobs import names, table_rows, write_raw  # noqa: F401

from retentide.plans import jobs
from retentide.schemas import EVENTS
from retentide.sources import quoted_lines, raw_events

HEADER = ",".join(EVENTS.fieldNames())
LINE = "2025-02-06 10:00:00.000000Z,{user},Female,like,{category},,ios,organic,SG"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def write_file(tmp_path, text, name="log.csv"):
    path = tmp_path / name
    path.write_text(text, newline="")
    return str(path)


@pytest.fixture
def small_splits(spark):
    held = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "257")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for key, value in held.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_splits_give_the_rows_of_one_task(spark, tmp_path, small_splits, seed):
    """Values longer than a split, splits that begin inside quotes, several files."""
    draw = random.Random(seed)

    def odd():
        pieces = ["\n", '"', ",", "x", "\n\n", " ", "longer text ", '"\n"', "\\"]
        return "".join(draw.choice(pieces) for _ in range(draw.choice([0, 3, 8, 120]))) or None

    rows = [event(n % 5, user=f"u_{n:04d}", transaction_category=odd()) for n in range(120)]
    path = str(tmp_path / "log")
    raw_events.write_raw_events(events(spark, rows).repartition(2), path)
    found = quoted_lines.read_quoted_lines(spark, path)
    assert rows_of(found) == rows_of(events(spark, rows).drop("event_date")) == rows_of(raw_events.read_raw_events(spark, path, multiline=True))
    assert quoted_lines._lines(spark, path).rdd.getNumPartitions() > 20


def test_line_ends_of_windows_and_blank_lines(spark, tmp_path, small_splits):
    body = [LINE.format(user="u_0001", category='"a\r\n\r\nb"'), "", LINE.format(user="u_0002", category='"said ""x"""'), "  ", LINE.format(user="u_0003", category="plain")]
    path = write_file(tmp_path, "\r\n".join([HEADER, *body, ""]))
    found = {r.user_id: r.transaction_category for r in quoted_lines.read_quoted_lines(spark, path).collect()}
    assert found == {"u_0001": "a\r\n\r\nb", "u_0002": 'said "x"', "u_0003": "plain"}


def test_files_without_such_breaks_are_read_as_they_are(spark, tmp_path):
    write_file(tmp_path, "\n".join([HEADER, LINE.format(user="u_0001", category='"a,b"'), ""]), "a b.csv")
    assert "Window" not in quoted_lines.read_quoted_lines(spark, str(tmp_path))._jdf.queryExecution().toString()
    write_file(tmp_path, "\n".join([HEADER, LINE.format(user="u_0002", category='"a\nb"'), ""]), "c [1].csv")
    write_file(tmp_path, HEADER + "\n", "empty.csv")
    found = quoted_lines.read_quoted_lines(spark, str(tmp_path))
    assert {(r.user_id, r.transaction_category) for r in found.collect()} == {("u_0001", "a,b"), ("u_0002", "a\nb")}


def test_broken_logs_fail(spark, tmp_path):
    record = LINE.format(user="u_0001", category='"a\nb"')
    with pytest.raises(ValueError, match="aren't closed"):
        quoted_lines.read_quoted_lines(spark, write_file(tmp_path, f'{HEADER}\n{record}\n"x\n', "open.csv"))
    for name, text in {"header": f"x{HEADER}\n{record}\n", "short": f'{HEADER}\n{record}\n"a\nb",1\n', "time": f"{HEADER}\n{record.replace('2025', 'y')}\n"}.items():
        with pytest.raises(Exception):
            quoted_lines.read_quoted_lines(spark, write_file(tmp_path, text, f"{name}.csv")).collect()


# The index of files


def days_log(spark, tmp_path, n_days, extra=()):
    """A file for each day, the days' files in one folder."""
    for n in range(n_days):
        rows = events(spark, [event(n, user=f"u_{u:04d}") for u in range(3)]).coalesce(1)
        raw_events.write_raw_events(rows, str(tmp_path / f"part {n}"))
        next((tmp_path / f"part {n}").glob("part-*.csv")).rename(tmp_path / "raw" / f"day {n}.csv")
    return str(tmp_path / "raw")


def opened(df):
    return sorted(unquote(f).rsplit("/", 1)[1] for f in df.inputFiles())


def test_a_day_opens_its_files_only(spark, tmp_path, names, monkeypatch):  # noqa: F811
    (tmp_path / "raw").mkdir()
    raw = days_log(spark, tmp_path, 4)
    jobs.create_tables(spark, names)
    assert opened(jobs.read_raw(spark, raw, day(2), names=names)) == ["day 2.csv"]
    assert opened(jobs.read_raw(spark, raw, day(1), day(2), names)) == ["day 1.csv", "day 2.csv"]
    assert jobs.read_raw(spark, raw, day(9), names=names).collect() == []
    # files that the index knows aren't read for it again
    read, kept = [], raw_events.index_files
    monkeypatch.setattr(raw_events, "index_files", lambda s, files: read.extend(r.file.rsplit("/", 1)[1] for r in files.collect()) or kept(s, files))
    jobs.read_raw(spark, raw, day(2), names=names)
    assert read == []
    late = events(spark, [event(1, user="u_0009"), event(3, user="u_0009")])
    late.select(*EVENTS.fieldNames()).toPandas().to_csv(tmp_path / "raw" / "late.csv", index=False, date_format="%Y-%m-%d %H:%M:%S.000000Z")
    assert opened(jobs.read_raw(spark, raw, day(1), names=names)) == ["day 1.csv", "late.csv"] and read == ["late.csv"]
    (tmp_path / "raw" / "day 1.csv").unlink()
    assert opened(jobs.read_raw(spark, raw, day(1), names=names)) == ["late.csv"]
    assert spark.table(names.raw_files).count() == 4


def test_loads_through_the_index_equal_those_of_the_whole_log(spark, tmp_path, names):  # noqa: F811
    (tmp_path / "raw").mkdir()
    raw = days_log(spark, tmp_path, 3)
    jobs.backfill(spark, raw, day(0), day(1), names, metrics=False)
    jobs.run_day(spark, raw, day(2), names, metrics=False)
    whole = raw_events.with_event_date(raw_events.read_raw_events(spark, raw))
    assert table_rows(spark, names.events) == rows_of(whole)


def test_events_without_a_time_are_counted_whatever_the_day(spark, tmp_path, names):  # noqa: F811
    (tmp_path / "raw").mkdir()
    raw = days_log(spark, tmp_path, 2)
    write_file(tmp_path / "raw", f"{HEADER}\n,{LINE.format(user='u_0001', category='').split(',', 1)[1]}\n", "timeless.csv")
    jobs.create_tables(spark, names)
    bad = {r.check: r.n_bad for r in jobs.check_bronze(spark, raw, day(1), names).collect()}
    assert bad["event_time_not_null"] == 1 and bad["row_counts_match"] == 1
    assert opened(jobs.read_raw(spark, raw, day(1), names=names)) == ["day 1.csv", "timeless.csv"]
    assert spark.table(names.raw_files).agg(F.sum("n_without_time")).first()[0] == 1


def test_a_log_of_one_file_is_read_whole(spark, tmp_path, names):  # noqa: F811
    raw = write_file(tmp_path, f"{HEADER}\n{LINE.format(user='u_0001', category='')}\n")
    jobs.create_tables(spark, names)
    assert jobs.read_raw(spark, raw, day(5), names=names).count() == 1
    assert spark.table(names.raw_files).count() == 0
