"""Run registered queries in Spark and their SQL in DuckDB; compare results.

Usage: python tests/oracle_compare.py [sf_dir] [query ...]

Comparison: same column names, same row count, and the same multiset of rows
(columns sorted by name, values normalised: floats to 9 significant digits,
timestamps to ISO text).
"""

from __future__ import annotations

import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return "<null>"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{v:.9g}"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    try:
        import numpy as np

        if isinstance(v, np.floating):
            return f"{float(v):.9g}"
        if isinstance(v, np.integer):
            return str(int(v))
    except ImportError:
        pass
    if isinstance(v, bool):
        return str(v)
    return str(v)


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = sorted(tuple(_norm(r[i]) for i in order) for r in rows)
    return [columns[i] for i in order], out


def compare(spark, con, name: str, fn, sql: str | None, sf_dir: str) -> dict:
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    res = {"query": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    res["oracle_rows"] = len(d_rows)
    sc, sr = canon(s_cols, s_rows)
    dc, dr = canon(d_cols, d_rows)
    if sc != dc:
        res["status"] = f"columns differ: {sc} vs {dc}"
    elif len(sr) != len(dr):
        res["status"] = "row count differs"
    elif sr != dr:
        diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
        res["status"] = f"values differ, e.g. {diff}"
    else:
        res["status"] = "match"
    return res


def main(argv):
    from tessera.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    wanted = argv[2:]
    import __spark_entry__ as entry

    spark = build_session("local[8]", 8)
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if wanted and name not in wanted:
            continue
        try:
            r = compare(spark, con, name, fn, sqls.get(name), sf_dir)
        except Exception as exc:  # report and continue
            r = {"query": name, "status": f"error: {type(exc).__name__}: {str(exc)[:300]}"}
        bad += r["status"] not in ("match", "rows-only")
        print(r, flush=True)
    print("mismatches:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
