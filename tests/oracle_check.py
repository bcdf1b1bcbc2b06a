"""Run registered queries on Spark and their DuckDB statements side by side.

Usage: python tests/oracle_check.py [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if hasattr(v, "item"):
        return v.item()
    return v


def _key(row):
    return tuple((x is None, "" if x is None else str(type(x)), x if x is not None else 0) for x in row)


def compare(spark, con, key: str, sf_dir: str, query, sql: str) -> dict:
    t0 = time.time()
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(_norm(x) for x in r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_rows = [tuple(_norm(x) for x in r) for r in rel.fetchall()]
    t2 = time.time()
    out = {"key": key, "spark_s": round(t1 - t0, 2), "duck_s": round(t2 - t1, 2),
           "rows": (len(s_rows), len(d_rows)), "ok": True, "why": ""}
    if sorted(s_cols) != sorted(d_cols):
        out.update(ok=False, why=f"columns {s_cols} vs {d_cols}")
        return out
    order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    d_idx = [d_cols.index(s_cols[i]) for i in order]
    s_sorted = sorted((tuple(r[i] for i in order) for r in s_rows), key=_key)
    d_sorted = sorted((tuple(r[i] for i in d_idx) for r in d_rows), key=_key)
    if len(s_sorted) != len(d_sorted):
        out.update(ok=False, why="row count")
        return out
    for a, b in zip(s_sorted, d_sorted):
        if a != b:
            out.update(ok=False, why=f"first diff spark={a} duck={b}")
            break
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    from __spark_entry__ import oracle_sql, queries
    from ledgerline.session import build_session

    spark = build_session("local[8]", 8)
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for k in keys or list(qs):
        if k not in sqls:
            print(f"{k:28s} NO ORACLE")
            continue
        try:
            r = compare(spark, con, k, sf_dir, qs[k], sqls[k])
        except Exception as e:  # report and continue
            r = {"key": k, "ok": False, "why": f"{type(e).__name__}: {str(e)[:300]}", "rows": None}
        bad += not r["ok"]
        print(f"{k:28s} {'OK ' if r['ok'] else 'BAD'} rows={r['rows']} "
              f"spark={r.get('spark_s')} duck={r.get('duck_s')} {r['why']}", flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
