"""Run registered queries next to their SQL: python tests/check.py [folder] [name ...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _value(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return "NULL"
    if isinstance(x, bool):
        return str(x)
    if isinstance(x, (int, float)):
        return f"{float(x):.9g}"
    return str(x)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_value(r[i]) for i in order) for r in rows)


def compare(df, con, sql) -> str | None:
    """None when equal, else what differs."""
    got_columns, got = rows_of(df.columns, df.collect())
    cursor = con.execute(sql)
    want_columns, want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    off = [(a, b) for a, b in zip(got, want) if a != b]
    return f"{len(off)} of {len(got)} rows differ, first {off[0]}" if off else None


if __name__ == "__main__":
    from shelfscout.queries import ORACLES, QUERIES
    from shelfscout.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, con = local_session(), connect(folder)
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, folder)
            if name in ORACLES:
                problem = compare(df, con, ORACLES[name])
                note = "ok" if problem is None else f"FAIL {problem}"
            else:
                note, problem = f"rows {df.count()}", None
        except Exception as error:  # noqa: BLE001
            note = problem = f"ERROR {type(error).__name__} {str(error)[:600]}"
        bad += problem is not None
        print(f"{name:32s} {time.time() - start:6.2f}s {note}", flush=True)
    print(f"{len(names)} run, {bad} bad")
