"""Run named queries in Spark and their SQL in DuckDB, and compare the rows.

    python tests/compare.py [folder] [name prefix ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return f"decimal {v}"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return f"{type(v).__name__} {v}"


def normal(columns: list[str], rows: list) -> list[tuple]:
    """Rows as text, columns by name, in a fixed order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_value(r[i]) for i in order) for r in rows)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), normal(df.columns, df.collect())


def oracle_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return sorted(columns), normal(columns, cursor.fetchall())


def difference(left, right) -> str | None:
    """None when equal, else a short text."""
    if left[0] != right[0]:
        return f"columns {left[0]} / {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"{len(left[1])} rows / {len(right[1])} rows"
    for a, b in zip(left[1], right[1]):
        if a != b:
            return f"{a} / {b}"
    return None


def main(argv: list[str]) -> int:
    from pyspark.sql import SparkSession

    from tidemark.queries import ORACLE, QUERIES

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    chosen = [n for n in sorted(QUERIES) if not argv[1:] or n.startswith(tuple(argv[1:]))]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(folder), 0
    for name in chosen:
        start = time.time()
        try:
            got = spark_rows(QUERIES[name](spark, folder))
            took = time.time() - start
            if name not in ORACLE:
                print(f"ROWS  {name} {len(got[1])} rows {took:.2f} s", flush=True)
                continue
            problem = difference(got, oracle_rows(con, ORACLE[name]))
        except Exception as e:  # report and go on with the next query
            took, problem = time.time() - start, f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        print(f"{'FAIL ' if problem else 'OK   '} {name} {took:.2f} s {problem or len(got[1])}", flush=True)
    print(f"{len(chosen)} queries, {failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
