"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tools/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, __import__("decimal").Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(v)
    if isinstance(v, pd.Timestamp):
        return v.tz_localize(None).isoformat() if v.tzinfo else v.isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    try:
        if pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows(df: pd.DataFrame):
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].astype(object).itertuples(index=False, name=None):
        out.append(tuple(_norm(x) for x in rec))
    return cols, sorted(out, key=repr)


def compare(spark, con, name, fn, sql, sf_dir, show=5):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    spd = pd.DataFrame([r.asDict(recursive=True) for r in sdf.collect()], columns=sdf.columns)
    t1 = time.time()
    if sql is None:
        print(f"{name:40s} spark_rows={len(spd):8d} (no oracle) {t1 - t0:6.1f}s")
        return True
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    dpd = pd.DataFrame(cur.fetchall(), columns=dcols)
    t2 = time.time()
    sc, sr = rows(spd)
    dc, dr = rows(dpd)
    ok = sc == dc and sr == dr
    print(f"{name:40s} {'OK ' if ok else 'BAD'} spark={len(sr):8d} duck={len(dr):8d} "
          f"spark {t1 - t0:5.1f}s duck {t2 - t1:5.1f}s")
    if not ok:
        if sc != dc:
            print("   columns differ:", sc, dc)
        else:
            a, b = set(sr), set(dr)
            print("   only spark:", list(a - b)[:show])
            print("   only duck :", list(b - a)[:show])
    return ok


def main():
    args = sys.argv[1:]
    sf_dir = "/root/testdata/sf0.01"
    if args and os.path.isdir(args[0]):
        sf_dir = args.pop(0)
    from demandlake import session as S
    from demandlake.oracle import ORACLE_SQL
    from demandlake.queries import QUERIES
    spark = S.build("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    names = args or list(QUERIES)
    bad = []
    for n in names:
        try:
            if not compare(spark, con, n, QUERIES[n], ORACLE_SQL.get(n), sf_dir):
                bad.append(n)
        except Exception as e:  # report and continue
            print(f"{n:40s} ERROR {type(e).__name__}: {str(e)[:400]}")
            bad.append(n)
    print("BAD:", bad)


if __name__ == "__main__":
    main()
