"""Cross-check every registered query against its DuckDB SQL (same idea as the driver's
correctness gate): row count, column names and an order-free comparison of all values.

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, bytes | bytearray):
        return bytes(v).hex()
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def rows_of(records):
    out = [tuple(norm(x) for x in r) for r in records]
    return sorted(out, key=repr)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    dcols = rel.columns
    drows = rel.fetchall()
    t2 = time.time()
    order = sorted(range(len(scols)), key=lambda i: scols[i])
    dorder = sorted(range(len(dcols)), key=lambda i: dcols[i])
    ok_cols = sorted(scols) == sorted(dcols)
    s = rows_of([tuple(r[i] for i in order) for r in srows])
    d = rows_of([tuple(r[i] for i in dorder) for r in drows]) if ok_cols else []
    ok = ok_cols and s == d
    print(f"{'OK ' if ok else 'BAD'} {name:32s} spark={len(srows):7d} duck={len(drows):7d} "
          f"({t1 - t0:.1f}s / {t2 - t1:.1f}s)", flush=True)
    if not ok:
        if not ok_cols:
            print("   columns spark:", sorted(scols), "\n   columns duck: ", sorted(dcols))
        else:
            ss, dd = set(s), set(d)
            print("   only spark:", list(ss - dd)[:3])
            print("   only duck: ", list(dd - ss)[:3])
    return ok


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as entry
    from tallyho.session import get_spark
    spark = get_spark()
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = []
    for name, fn in qs.items():
        if names and name not in names:
            continue
        if name not in sqls:
            df = fn(spark, sf_dir)
            print(f"--  {name:32s} spark={df.count():7d} (no SQL form)")
            continue
        if not compare(spark, con, name, fn, sqls[name], sf_dir):
            bad.append(name)
    print("FAILED:", bad if bad else "none")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
