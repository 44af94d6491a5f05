"""Run registered queries in Spark and their SQL twins in DuckDB and compare.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
Compares row count, column names and the multiset of rows (doubles to 6 places).
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in records), key=repr)


def compare(spark, name: str, fn, sql: str, sf_dir: str, con) -> tuple[bool, str]:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = rows_of(s_cols, [tuple(r) for r in sdf.collect()])
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = rows_of(d_cols, res.fetchall())
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={sorted(s_cols)} sql={sorted(d_cols)}"
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} sql={len(d_rows)}"
    if s_rows != d_rows:
        bad = next(i for i, (a, b) in enumerate(zip(s_rows, d_rows)) if a != b)
        return False, f"values differ at sorted row {bad}: spark={s_rows[bad]} sql={d_rows[bad]}"
    return True, f"{len(s_rows)} rows, spark {t1 - t0:.1f}s"


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from userflow.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = build_session()
    con = duck(sf_dir)
    qs, sql = queries(), oracle_sql()
    failures = 0
    for name in names or list(qs):
        if name not in sql:
            t0 = time.time()
            n = qs[name](spark, sf_dir).count()
            print(f"ROWS  {name}: {n} rows ({time.time() - t0:.1f}s)", flush=True)
            continue
        try:
            ok, msg = compare(spark, name, qs[name], sql[name], sf_dir, con)
        except Exception as e:  # report and continue
            ok, msg = False, f"error: {type(e).__name__}: {str(e)[:400]}"
        failures += not ok
        print(f"{'OK  ' if ok else 'FAIL'}  {name}: {msg}", flush=True)
    print(f"failures: {failures}")
    return failures


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
