"""Compare queries with their expected SQL: python -m harness.compare [sf_dir] [query ...]"""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from decimal import Decimal

import duckdb

from harness.oracle import oracle_sql
from harness.queries import REGISTRY
from harness.session import local_session


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value: object) -> str:
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def canonical(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple[str, ...]]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(spark, con, sf_dir: str, name: str, sql: str) -> str | None:
    df = REGISTRY[name](spark, sf_dir)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    want = canonical(columns, cursor.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows != {len(want[1])}"
    wrong = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    expected = oracle_sql()
    names = sys.argv[2:] or list(REGISTRY)
    spark, con, failed = local_session(8), connect(sf_dir), 0
    for name in names:
        started = time.time()
        if name not in expected:
            print(f"no SQL  {name}")
            continue
        try:
            wrong = difference(spark, con, sf_dir, name, expected[name])
        except Exception as error:
            wrong = f"{type(error).__name__}: {str(error)[:600]}"
        failed += wrong is not None
        print(f"{'FAIL' if wrong else 'ok':7} {name} {time.time() - started:.1f}s {wrong or ''}", flush=True)
    print(f"{len(names)} queries, {failed} failed; SQL without a query: {sorted(set(expected) - set(REGISTRY))}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
