"""Compare registered queries with their SQL in DuckDB.

    python check.py [--sf DIR] [name or prefix ...]
"""

from __future__ import annotations

import argparse
import glob
import math
import os
import sys
import time

import duckdb

from tallyhouse.queries import oracle_sql, queries
from tallyhouse.session import local_session


def canon(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return float(v) if isinstance(v, float) else v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(canon(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for path in glob.glob(f"{args.sf}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    spark = local_session()
    sqls, bad = oracle_sql(), []
    for name, build in queries().items():
        if args.names and not any(name.startswith(n) for n in args.names):
            continue
        start = time.time()
        try:
            df = build(spark, args.sf)
            got = rows_of(df.columns, [tuple(r) for r in df.collect()])
            took = time.time() - start
            if name not in sqls:
                print(f"{name:38s} rows {len(got[1]):7d} no sql {took:6.2f}s", flush=True)
                continue
            cur = con.execute(sqls[name])
            want = rows_of([d[0] for d in cur.description], cur.fetchall())
        except Exception as e:  # noqa: BLE001
            bad.append(name)
            print(f"{name:38s} ERROR {str(e)[:600]}", flush=True)
            continue
        ok = got == want
        print(f"{name:38s} rows {len(got[1]):7d} {'ok' if ok else 'DIFF'} {took:6.2f}s", flush=True)
        if not ok:
            bad.append(name)
            print("   spark", got[0], len(got[1]), "sql", want[0], len(want[1]))
            shown = 0
            for a, b in zip(got[1], want[1]):
                if a != b and shown < 3:
                    shown += 1
                    print("   ", [(c, x, y) for c, x, y in zip(got[0], a, b) if x != y][:6])
    print("failed:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
