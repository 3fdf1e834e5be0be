"""Run queries on Spark and their SQL on DuckDB over the same tables and compare the rows.

    python tools/compare.py [folder] [query ...]
"""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from netloom.queries import all_queries  # noqa: E402
from netloom.queries.registry import TABLES  # noqa: E402
from netloom.session import build_session  # noqa: E402


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr), [columns[i] for i in order]


def main(folder: str, names: list[str]) -> int:
    stages = f"{Path.cwd()}/spark-warehouse/compare-stages"
    spark = build_session(
        "compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="16g", spark__ui__showConsoleProgress="false", spark__sql__session__timeZone="UTC",
        spark__checkpoint__dir=stages,
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    failed = 0
    for name, query in all_queries().items():
        if names and name not in names:
            continue
        try:
            start = time.time()
            df = query(spark, folder)
            got, cols = rows_of(df.columns, [tuple(r) for r in df.collect()])
            took = time.time() - start
            if query.sql is None:
                print(f"rows  {name}: {len(got)} rows, {took:.1f} s", flush=True)
                continue
            start = time.time()
            cur = db.execute(query.sql)
            want_cols = [d[0] for d in cur.description]
            want, want_cols = rows_of(want_cols, cur.fetchall())
            sql_took = time.time() - start
            same = cols == want_cols and got == want
            failed += not same
            print(f"{'ok   ' if same else 'DIFF '} {name}: {len(got)}/{len(want)} rows, {took:.1f} s / {sql_took:.1f} s", flush=True)
            if not same:
                print("   columns", cols, want_cols)
                left, right = set(map(repr, got)), set(map(repr, want))
                print("   only spark", len(left - right), sorted(left - right)[:3])
                print("   only sql  ", len(right - left), sorted(right - left)[:3], flush=True)
        except Exception:
            failed += 1
            print(f"FAIL  {name}\n{traceback.format_exc()[-1800:]}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    sys.exit(1 if main(folder, sys.argv[2:]) else 0)
