"""Run queries on Spark and DuckDB and compare: ``python -m checks.compare <folder> [name ...]``."""
from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

from checks.queries import ORACLES, QUERIES
from ledgermill.session import build_session


def plain(value):
    """A value as both engines spell it."""
    if hasattr(value, "isoformat"):
        return value.isoformat()[:10] if not hasattr(value, "hour") else value.isoformat()
    if isinstance(value, float):
        return "nan" if math.isnan(value) else (int(value) if value == int(value) and abs(value) < 1e15 else value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def main() -> int:
    folder, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session("local[8]", "compare", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for name in ("orders", "lineitem"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    bad = 0
    for name, run in QUERIES.items():
        if wanted and name not in wanted:
            continue
        started = time.perf_counter()
        try:
            df = run(spark, folder)
            got_columns, got = rows_of(df.columns, df.collect())
            seconds = time.perf_counter() - started
            if name not in ORACLES:
                print(f"{name:28} rows only {sum(got.values())}  {seconds:.1f}s", flush=True)
                continue
            cursor = con.execute(ORACLES[name])
            columns, expected = rows_of([d[0] for d in cursor.description], cursor.fetchall())
        except Exception as problem:  # report and go on
            bad += 1
            print(f"{name:28} ERROR {type(problem).__name__}: {str(problem)[:400]}", flush=True)
            continue
        if got_columns != columns:
            bad += 1
            print(f"{name:28} COLUMNS {set(got_columns) ^ set(columns)}", flush=True)
        elif got != expected:
            bad += 1
            only_spark, only_duck = got - expected, expected - got
            print(f"{name:28} DIFFERS {sum(got.values())} vs {sum(expected.values())} rows, "
                  f"{sum(only_spark.values())} differ\n   {columns}\n   spark {list(only_spark)[:3]}\n"
                  f"   duck  {list(only_duck)[:3]}", flush=True)
        else:
            print(f"{name:28} ok {sum(got.values())} rows  {seconds:.1f}s", flush=True)
    print("failing:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(min(main(), 1))
