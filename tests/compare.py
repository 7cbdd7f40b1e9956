"""Run a registered query and its SQL, compare as the driver does: columns by name, rows in any order."""

from __future__ import annotations

import math
import os
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def sql_rows(sql: str, folder: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        path = os.path.join(folder, f"{table}.parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    return names, cursor.fetchall()


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float) and not math.isnan(value):
        return value + 0.0
    if isinstance(value, list):
        return tuple(_plain(v) for v in value)
    return value


def normal(names: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(out, key=repr)


def differences(df, sql: str, folder: str) -> str | None:
    """None when equal, else a short description."""
    got_names, got = normal(df.columns, [tuple(r) for r in df.collect()])
    want_names, want = normal(*sql_rows(sql, folder))
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        only_got = [g for g in got if g not in set(want)][:2]
        only_want = [w for w in want if w not in set(got)][:2]
        return f"{len(bad)} rows differ; got {str(only_got)[:1500]} want {str(only_want)[:1500]}"
    return None
