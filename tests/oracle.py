"""Compare registered queries with their SQL in DuckDB.

    python tests/oracle.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(plain(r[i]) for i in order) for r in rows), key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> str | None:
    """None if equal, else a short report."""
    df = fn(spark, sf_dir)
    got_cols, got = normal(df.columns, [tuple(r) for r in df.collect()])
    rel = con.execute(sql)
    want_cols, want = normal([d[0] for d in rel.description], rel.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}; e.g. {got[:2]} / {want[:2]}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} rows differ, e.g. {bad[0]}" if bad else None


if __name__ == "__main__":
    from changeflow.session import local_session
    import __spark_entry__ as entry

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = local_session(8)
    con = connect(sf_dir)
    failed = 0
    for name, sql in entry.oracle_sql().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            report = compare(spark, con, name, entry.queries()[name], sql, sf_dir)
        except Exception as error:  # noqa: BLE001
            report = f"{type(error).__name__}: {str(error)[:600]}"
        failed += report is not None
        print(f"{'FAIL' if report else 'ok  '} {name} {time.time() - start:.1f}s {report or ''}", flush=True)
    print(f"{failed} failed")
