"""Compare every registered Spark query with its DuckDB oracle, as the driver does.

Usage: python tests/oracle_check.py [sf_dir] [key ...]
Prints one line per key: OK / MISMATCH / ERROR with row counts.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402


TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "item"):
        return norm(v.item())
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    import __spark_entry__ as E
    from tessera.plans.session import build_session

    spark = build_session()
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for key, fn in qs.items():
        if only and key not in only:
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf_dir)
            scols = sdf.columns
            srows = [tuple(r) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"ERROR-SPARK {key}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if key not in sqls:
            print(f"ROWS-ONLY {key}: rows={len(srows)} cols={scols} {ts:.1f}s")
            continue
        try:
            res = con.execute(sqls[key])
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"ERROR-DUCK {key}: {str(e)[:400]}")
            bad += 1
            continue
        if sorted(scols) != sorted(dcols):
            print(f"SCHEMA {key}: spark={sorted(scols)} duck={sorted(dcols)}")
            bad += 1
            continue
        a, b = rows_of(scols, srows), rows_of(dcols, drows)
        if a == b:
            print(f"OK {key}: rows={len(a)} {ts:.1f}s")
        else:
            bad += 1
            sa, sb = set(a), set(b)
            print(f"MISMATCH {key}: spark={len(a)} duck={len(b)} cols={sorted(scols)}")
            print("   spark-only:", list(sa - sb)[:3])
            print("   duck-only: ", list(sb - sa)[:3])
    print(f"bad={bad}")


if __name__ == "__main__":
    main()
