"""Run registered queries and their SQL side by side and compare the rows.

    python tools/check_oracle.py [--sf DIR] [name-prefix ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb

from tidemark import build_session
from tidemark.plans import catalog
from tidemark.plans.views import TABLES


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "∅"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return f"{float(value):.9g}"
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = build_session(
        master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="12g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    duck = duckdb.connect()
    for table in TABLES:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{args.sf}/{table}.parquet'")
    bad = []
    for name, q in catalog().items():
        if args.names and not any(name.startswith(p) for p in args.names):
            continue
        start = time.time()
        try:
            df = q.run(spark, args.sf)
            got = df.collect()
        except Exception as exc:
            print(f"FAIL {name}: {str(exc)[:1500]}")
            bad.append(name)
            continue
        took = time.time() - start
        if q.sql is None:
            print(f"rows {name:40s} {len(got):7d} rows {took:6.2f}s  (no SQL)")
            if not got:
                bad.append(name)
            continue
        try:
            cur = duck.execute(q.sql)
            names = [d[0] for d in cur.description]
            want = cur.fetchall()
        except Exception as exc:
            print(f"FAIL {name} SQL: {str(exc)[:700]}")
            bad.append(name)
            continue
        a, b = rows_of(df.columns, got), rows_of(names, want)
        if sorted(df.columns) != sorted(names):
            print(f"FAIL {name}: columns {sorted(df.columns)} != {sorted(names)}")
            bad.append(name)
        elif a != b:
            only_a = [r for r in a if r not in set(b)][:3]
            only_b = [r for r in b if r not in set(a)][:3]
            print(f"FAIL {name}: {len(a)} vs {len(b)} rows\n   spark {only_a}\n   sql   {only_b}")
            bad.append(name)
        elif not a:
            print(f"EMPTY {name}")
            bad.append(name)
        else:
            print(f"ok   {name:40s} {len(a):7d} rows {took:6.2f}s")
    print("bad:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
