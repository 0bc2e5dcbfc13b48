"""Run a registered query on Spark and its SQL on DuckDB, and compare rows and types."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        if path.exists():
            con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return con


def _kind(value):
    if isinstance(value, dt.datetime):
        return "timestamp"
    return {bool: "bool", int: "int", float: "float", str: "str", dt.date: "date"}.get(type(value))


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], [tuple(r[i] for i in order) for r in rows]


def differences(query, sql, spark, sf_dir, con) -> str:
    """Empty when equal, else a short description."""
    got = query(spark, sf_dir)
    got_names, got_rows = _rows(got.columns, [tuple(r) for r in got.collect()])
    relation = con.sql(sql)
    want_names, want_rows = _rows(relation.columns, relation.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    for i, name in enumerate(got_names):
        kinds = [{_kind(r[i]) for r in rows} - {None} for rows in (got_rows, want_rows)]
        if kinds[0] != kinds[1]:
            return f"column {name}: {kinds[0]} != {kinds[1]}"
    extra, missing = Counter(got_rows) - Counter(want_rows), Counter(want_rows) - Counter(got_rows)
    if extra or missing:
        return (
            f"{got_names}: {len(got_rows)} rows, {len(want_rows)} expected; "
            f"extra {list(extra)[:3]}, missing {list(missing)[:3]}"
        )
    return "" if got_rows else "no rows"
