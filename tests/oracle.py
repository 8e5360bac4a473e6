"""Compares registered queries with their SQL. ``python tests/oracle.py [folder] [name ...]`` runs them by hand."""

from __future__ import annotations

import datetime
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
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if isinstance(v, bool) or v is None:
        return repr(v)
    if isinstance(v, (int, float)):
        return repr(float(v))
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, folder: str, name: str, query, sql: str | None) -> str | None:
    """What differs, or None."""
    df = query(spark, folder)
    got_columns, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if not got:
        return "no rows"
    if sql is None:
        return None
    answer = con.execute(sql)
    want_columns, want = _rows([d[0] for d in answer.description], answer.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from tablelearn.session import local_session

    args = sys.argv[1:]
    folder = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark, con = local_session(8), connect(folder)
    sqls, failed = oracle_sql(), 0
    for name, q in queries().items():
        if args and name not in args:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, folder, name, q, sqls.get(name))
        except Exception as e:  # noqa: BLE001 - a broken query must not hide the others
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        state = "ok" if problem is None else f"BAD {problem}"
        print(f"{name:32} {time.time() - start:6.2f}s {'' if name in sqls else '(rows only) '}{state}", flush=True)
    print("failed:", failed)
    spark.stop()


if __name__ == "__main__":
    main()
