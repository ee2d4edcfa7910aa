"""Run registered queries and compare each with its SQL on DuckDB.

Usage: python tools/parity.py [folder] [name ...]
"""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from meterline.catalog import load_all  # noqa: E402
from meterline.session import build_session  # noqa: E402


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, datetime.datetime) and value.tzinfo is not None:
        value = value.astimezone(datetime.timezone.utc).replace(tzinfo=None)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, decimal.Decimal):
        return float(value)
    return value


def rows(names, data):
    order = sorted(range(len(names)), key=names.__getitem__)
    out = [tuple(plain(row[i]) for i in order) for row in data]
    return [names[i] for i in order], sorted(out, key=repr)


def kinds(table):
    """Column kinds whose text form differs between engines when nulls are present."""
    columns, data = table
    return {c: {type(r[i]).__name__ for r in data} for i, c in enumerate(columns)}


def main() -> int:
    args = sys.argv[1:]
    folder = args.pop(0) if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    registry = load_all()
    unknown = [a for a in args if a not in registry]
    if unknown:
        raise SystemExit(f"no such query: {unknown}")
    spark = build_session("parity", "local[8]", spark__ui__showConsoleProgress="false", spark__sql__shuffle__partitions="8", spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    bad = []
    for name in args or list(registry):
        q = registry[name]
        began = time.time()
        try:
            result = q.fn(spark, folder)
            mine = rows(result.columns, result.collect())
            took = time.time() - began
            if q.sql is None:
                print(f"rows {name} {len(mine[1])} {took:.1f}s", flush=True)
                continue
            cursor = con.execute(q.sql)
            theirs = rows([d[0] for d in cursor.description], cursor.fetchall())
            mixed = [c for c, k in kinds(mine).items() if {"int", "NoneType"} <= k]
            if mixed or kinds(mine) != kinds(theirs):
                print(f"     {name} kinds", mixed, {c: (k, kinds(theirs).get(c)) for c, k in kinds(mine).items()
                                              if k != kinds(theirs).get(c)})
            if mine == theirs:
                print(f"ok   {name} {len(mine[1])} {took:.1f}s", flush=True)
                continue
            bad.append(name)
            print(f"DIFF {name} rows {len(mine[1])} vs {len(theirs[1])} {took:.1f}s", flush=True)
            if mine[0] != theirs[0]:
                print("  columns", mine[0], theirs[0])
            for a, b in [(a, b) for a, b in zip(mine[1], theirs[1]) if a != b][:3]:
                print("  spark ", a, "\n  duckdb", b)
        except Exception as error:  # keep going: one report for all queries
            bad.append(name)
            print(f"FAIL {name} {str(error)[:600]}", flush=True)
            if len(args) == 1:
                traceback.print_exc()
    print("bad:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
