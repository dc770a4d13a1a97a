"""Run registered queries next to their check SQL and compare sorted values."""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def plain(value):
    if value is None:
        return "\u0000null"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6) + 0.0)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, int) or type(value).__name__ == "Decimal":
        return repr(int(value)) if value == int(value) else repr(float(value))
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, sf: str, query, sql: str) -> tuple[str, int]:
    df = query(spark, sf)
    columns, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    names, want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if columns != names:
        return f"columns {columns} / {names}", len(got)
    if len(got) != len(want):
        extra = set(got) - set(want)
        missing = set(want) - set(got)
        return f"rows {len(got)} / {len(want)} extra {list(extra)[:2]} missing {list(missing)[:2]}", len(got)
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    if wrong:
        extra = set(got) - set(want)
        missing = set(want) - set(got)
        return f"{len(wrong)} values differ; extra {sorted(extra)[:2]} missing {sorted(missing)[:2]}"[:600], len(got)
    return "", len(got)


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from wordloom.session import build_session

    folder = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
    session = build_session("local[8]", 8)
    session.sparkContext.setLogLevel("ERROR")
    duck = connect(folder)
    sqls = entry.oracle_sql()
    for name, fn in entry.queries().items():
        if len(sys.argv) > 1 and name not in sys.argv[1:]:
            continue
        start = time.time()
        try:
            if name in sqls:
                problem, n = compare(session, duck, folder, fn, sqls[name])
            else:
                problem, n = "", fn(session, folder).count()
        except Exception as error:  # report and go on to the next query
            problem, n = f"{type(error).__name__}: {str(error)[:500]}", -1
        print(f"{'FAIL' if problem else 'ok  '} {name} rows={n} {time.time() - start:.1f}s {problem}", flush=True)
