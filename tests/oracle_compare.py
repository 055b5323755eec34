"""Compare registered Spark queries with their DuckDB oracle text.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
Prints one line per query: OK / MISMATCH / ERROR with row counts."""

from __future__ import annotations

import datetime
import math
import os
import sys
import time
from collections import Counter

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _canon(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return f"{v:.6f}"
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _canon(v.item())
        except Exception:
            pass
    if isinstance(v, (datetime.datetime,)):
        return v.strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(v, datetime.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_canon(x) for x in v) + "]"
    return str(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], Counter(tuple(_canon(r[i]) for i in order) for r in rows)


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, sf_dir, name, fn, sql):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    scols, scnt = rows_of(sdf.columns, srows)
    if sql is None:
        return f"NO-ORACLE {name}: rows={len(srows)} spark={t1 - t0:.1f}s"
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    t2 = time.time()
    dcols, dcnt = rows_of(dcols, drows)
    if scols != dcols:
        return f"MISMATCH {name}: columns spark={scols} duck={dcols}"
    if scnt != dcnt:
        only_s = list((scnt - dcnt).elements())[:3]
        only_d = list((dcnt - scnt).elements())[:3]
        return (f"MISMATCH {name}: rows spark={len(srows)} duck={len(drows)}\n  spark-only {only_s}\n"
                f"  duck-only {only_d}")
    return f"OK {name}: rows={len(srows)} spark={t1 - t0:.1f}s duck={t2 - t1:.1f}s"


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from catalytics.session import build_session
    import __spark_entry__ as E
    spark = build_session()
    qs, os_ = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in (names or sorted(qs)):
        try:
            line = compare(spark, con, sf_dir, name, qs[name], os_.get(name))
        except Exception as e:  # report and continue
            line = f"ERROR {name}: {type(e).__name__}: {str(e)[:600]}"
        if not line.startswith(("OK", "NO-ORACLE")):
            bad += 1
        print(line, flush=True)
    print(f"done: {len(names or qs)} queries, {bad} not ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
