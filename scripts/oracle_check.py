"""Run registered queries in Spark and their DuckDB twins; compare results.

Usage: python scripts/oracle_check.py [sf_dir] [key-prefix ...]
Mirrors the correctness gate: row count, column names, and an
order-insensitive comparison of values (floats rounded to 6 digits).
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from quarry.plans import all_oracles, all_queries  # noqa: E402
from quarry.session import get_session  # noqa: E402
from quarry.sources.tables import TABLES, table_path  # noqa: E402


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def rows_key(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = sys.argv[2:]
    spark = get_session("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{table_path(sf_dir, t)}'")
    qs, orc = all_queries(), all_oracles()
    bad = 0
    for key, fn in qs.items():
        if prefixes and not any(key.startswith(p) for p in prefixes):
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            cols = df.columns
            srows = [tuple(r) for r in df.collect()]
        except Exception as e:  # report and continue
            print(f"{key:28s} SPARK-ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if key not in orc:
            print(f"{key:28s} rows={len(srows):8d} (no oracle) {ts:6.1f}s")
            continue
        try:
            res = con.sql(orc[key])
            ocols = res.columns
            orows = res.fetchall()
        except Exception as e:
            print(f"{key:28s} DUCK-ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ok_cols = sorted(cols) == sorted(ocols)
        ok_n = len(srows) == len(orows)
        ok_v = ok_cols and ok_n and rows_key(srows, cols) == rows_key(orows, ocols)
        status = "OK" if ok_v else "MISMATCH"
        if not ok_v:
            bad += 1
        print(f"{key:28s} {status:8s} rows={len(srows)}/{len(orows)} cols={'ok' if ok_cols else (cols, ocols)} {ts:6.1f}s")
        if ok_cols and ok_n and not ok_v:
            a, b = rows_key(srows, cols), rows_key(orows, ocols)
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            print("   first diffs:", diff)
    print("bad:", bad)


if __name__ == "__main__":
    main()
