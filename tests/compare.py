"""Run queries and their SQL side by side: ``python tests/compare.py [sf_dir] [query ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clinspark.oracle import ORACLE_SQL  # noqa: E402
from clinspark.queries import QUERIES, TABLES  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canonical(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    return "" if value is None else f"{type(value).__name__}:{value}"


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(canonical(r[i]) for i in order) for r in rows)


def differences(spark, con, sf_dir: str, name: str, inspect=None) -> tuple[str | None, int, float]:
    """What differs (None when nothing does), the number of rows, and Spark's seconds."""
    begin = time.time()
    df = QUERIES[name](spark, sf_dir)
    if inspect:
        inspect(df)
    got = [tuple(r) for r in df.collect()]
    seconds = time.time() - begin
    cursor = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}", len(got), seconds
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}", len(got), seconds
    a, b = rows_of(df.columns, got), rows_of(columns, want)
    for x, y in zip(a, b):
        if x != y:
            return f"values {x} != {y}", len(got), seconds
    return None, len(got), seconds


def main(argv: list[str]) -> int:
    from clinspark.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8",
                          spark__ui__enabled="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), 0
    for name in names:
        try:
            problem, n, seconds = differences(spark, con, sf_dir, name)
        except Exception as error:
            problem, n, seconds = f"{type(error).__name__}: {str(error)[:600]}", 0, 0.0
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name:22s} {n:8d} {seconds:6.2f}s {problem or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} equal")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
