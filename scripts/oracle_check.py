"""Run registered queries in Spark and their SQL oracles in DuckDB; compare.

usage: python scripts/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from fieldbook.session import build_session  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=repr)


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def main():
    import faulthandler
    faulthandler.dump_traceback_later(int(os.environ.get("CHECK_DUMP_AFTER", "0")) or 10**6, exit=True)
    args = sys.argv[1:]
    sf_dir = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    names = [a for a in args if not os.path.isdir(a)]
    import importlib
    entry = importlib.import_module("__spark_entry__")
    qs, sqls = entry.queries(), entry.oracle_sql()
    spark = build_session()
    con = duck(sf_dir)
    bad = 0
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"ROWS {name}: {len(srows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            cur = con.execute(sqls[name])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        sc, sr = canon(scols, srows)
        dc, dr = canon(dcols, drows)
        if sc != dc:
            print(f"FAIL {name}: columns spark={sc} duck={dc}")
            bad += 1
        elif sr != dr:
            ss, ds = set(sr), set(dr)
            diff_s = [r for r in sr if r not in ds][:3]
            diff_d = [r for r in dr if r not in ss][:3]
            print(f"FAIL {name}: rows spark={len(sr)} duck={len(dr)} spark-only={diff_s} duck-only={diff_d}")
            bad += 1
        else:
            print(f"OK   {name}: {len(sr)} rows {ts:.1f}s")
    print(f"{bad} failing")
    spark.stop()
    sys.exit(1 if bad else 0)


if __name__ == "__main__":
    main()
