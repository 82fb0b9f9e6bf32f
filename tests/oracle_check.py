"""Run registered queries against their DuckDB oracles (not collected by pytest).

    python tests/oracle_check.py [sf_dir] [name ...]

Prints one line per query: row counts and whether the order-insensitive
content matches.
"""

from __future__ import annotations

import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, pd.Timestamp):
        v = v.to_pydatetime()
    if hasattr(v, "tzinfo") and getattr(v, "tzinfo", None) is not None:
        v = v.replace(tzinfo=None)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if isinstance(v, float):
        return repr(round(v, 9))
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows), sorted(cols)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    import __spark_entry__ as E
    from tradelake import get_session

    spark = get_session("local[8]", conf={"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        df = fn(spark, sf)
        srows = [tuple(r) for r in df.collect()]
        scols = df.columns
        secs = time.time() - t0
        if name not in sqls:
            print(f"{name:24s} spark={len(srows):7d} (no oracle) {secs:6.1f}s")
            continue
        res = con.execute(sqls[name])
        dcols = [d[0] for d in res.description]
        drows = res.fetchall()
        a, ac = canon(srows, scols)
        b, bc = canon(drows, dcols)
        ok = a == b and ac == bc
        bad += not ok
        print(f"{name:24s} spark={len(srows):7d} duck={len(drows):7d} {'OK ' if ok else 'BAD'} {secs:6.1f}s")
        if not ok:
            if ac != bc:
                print("   cols", ac, bc)
            else:
                sa, sb = set(a), set(b)
                print("   spark-only", list(sa - sb)[:3])
                print("   duck-only ", list(sb - sa)[:3])
    print("mismatches:", bad)


if __name__ == "__main__":
    main()
