"""Compare registered queries with their SQL in DuckDB: python tests/oracle.py [sf_dir] [names...]"""

from __future__ import annotations

import math
import os
import sys
import tempfile
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


def difference(spark, con, run, sql, sf) -> tuple[str | None, int]:
    """None when equal, else what differs."""
    df = run(spark, sf)
    got_cols, got = canonical(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want_cols, want = canonical([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} <> {want_cols}", len(got)
    if len(got) != len(want):
        return f"rows {len(got)} <> {len(want)}: {list(set(got) ^ set(want))[:3]}", len(got)
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return (f"{len(bad)} rows differ, e.g. {bad[0]}" if bad else None), len(got)


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from gaugeworks import build_session

    args = sys.argv[1:]
    sf = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or list(queries())
    spark = build_session(master="local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="oracle-")})
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf), 0
    for name in names:
        start = time.time()
        try:
            if name in oracle_sql():
                problem, n = difference(spark, con, queries()[name], oracle_sql()[name], sf)
            else:
                problem, n = None, queries()[name](spark, sf).count()
        except Exception as e:  # reported, the run goes on
            problem, n = f"{type(e).__name__}: {str(e)[:600]}", -1
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok':4} {name:32} {n:8} rows {time.time() - start:6.2f}s {problem or ''}", flush=True)
    print(f"{len(names) - failed}/{len(names)} equal")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
