"""Run registered queries next to their check SQL and compare whole results.

    python check.py [--sf 0.01] [name-prefix ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time
from decimal import Decimal

import duckdb

from silverlode.session import local_session
from workbook import load_all

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(folder: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return con


def _cell(value):
    if isinstance(value, Decimal):
        return ("decimal", str(value))
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def compare(case, spark, folder, con):
    started = time.time()
    df = case.run(spark, folder)
    got = df.collect()
    seconds = time.time() - started
    if case.sql is None:
        return seconds, f"rows only ({len(got)})", True
    result = con.execute(case.sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return seconds, f"columns differ: {sorted(set(names) ^ set(df.columns))}", False
    left, right = rows_of(df.columns, got), rows_of(names, expected)
    kinds = dict(df.dtypes)
    known = {"BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date", "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean"}
    odd = [f"{d[0]}: {d[1]} / {kinds[d[0]]}" for d in result.description if known.get(str(d[1])) != kinds[d[0]]]
    note = f" TYPES {odd}" if odd else ""
    if left == right:
        return seconds, f"equal ({len(left)} rows){note}", not odd
    if len(left) != len(right):
        return seconds, f"row counts differ: {len(left)} / {len(right)}{note}", False
    ordered = sorted(names)
    for a, b in zip(left, right):
        if a != b:
            where = [(ordered[i], a[i], b[i]) for i in range(len(a)) if a[i] != b[i]]
            return seconds, f"values differ, e.g. {where[:4]}{note}", False
    return seconds, "types differ", False


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    folder = f"/root/testdata/sf{args.sf}"
    cases = load_all()
    chosen = [c for n, c in cases.items() if not args.names or any(n == p or n.startswith(p) for p in args.names)]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    failed = 0
    for case in chosen:
        try:
            seconds, text, good = compare(case, spark, folder, con)
        except Exception as error:  # noqa: BLE001 - report and go on
            seconds, text, good = 0.0, f"{type(error).__name__}: {str(error)[:600]}", False
        failed += not good
        if not good or seconds > 3:
            print(f"{'ok  ' if good else 'FAIL'} {case.name:38s} {seconds:6.2f}s {text}", flush=True)
    print(f"{len(chosen)} run, {failed} failed", flush=True)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
