"""Run every registered query in Spark and its oracle SQL in DuckDB; compare.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
Compares column names, row counts and the sorted multiset of rows (doubles
rounded to 9 significant digits).
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=_key)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    import __spark_entry__ as E
    from roadlens.session import build_session
    spark = build_session("local[8]", 8)
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        df = fn(spark, sf_dir)
        srows = [tuple(r) for r in df.collect()]
        dt = time.time() - t0
        scols = df.columns
        if name not in sqls:
            print(f"{name:24s} spark-only rows={len(srows)} {dt:.2f}s")
            continue
        res = con.execute(sqls[name])
        dcols = [d[0] for d in res.description]
        drows = res.fetchall()
        sc, sr = canon(scols, srows)
        dc, dr = canon(dcols, drows)
        ok = sc == dc and sr == dr
        bad += not ok
        print(f"{name:24s} {'OK ' if ok else 'BAD'} rows spark={len(srows)} duck={len(drows)} {dt:.2f}s")
        if not ok:
            print("   cols", sc, dc)
            diff_s = [r for r in sr if r not in set(dr)][:3]
            diff_d = [r for r in dr if r not in set(sr)][:3]
            print("   spark-only", diff_s)
            print("   duck-only ", diff_d)
    print("mismatches:", bad)


if __name__ == "__main__":
    main()
