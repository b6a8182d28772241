"""Runs registered queries in Spark and their SQL in DuckDB and compares all rows.

`python tests/compare.py [sf] [query ..]` prints one line per query.
"""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, decimal.Decimal):
        return f"decimal {value}"
    return value


def _sorted_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def duckdb_rows(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    import duckdb

    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    result = connection.execute(sql)
    columns = [c[0] for c in result.description]
    return sorted(columns), _sorted_rows(columns, result.fetchall())


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), _sorted_rows(df.columns, df.collect())


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracle = contract.queries(), contract.oracle_sql()
    for name in sys.argv[2:] or queries:
        started = time.time()
        try:
            columns, rows = spark_rows(queries[name](spark, sf_dir))
        except Exception as error:  # noqa: BLE001
            print(f"{name:28} FAILED {str(error)[:600]}", flush=True)
            continue
        taken = time.time() - started
        if name not in oracle:
            print(f"{name:28} {taken:6.2f}s {len(rows):7} rows, no SQL", flush=True)
            continue
        expected_columns, expected = duckdb_rows(oracle[name], sf_dir)
        verdict = "ok" if (columns, rows) == (expected_columns, expected) else "DIFFERS"
        print(f"{name:28} {taken:6.2f}s {len(rows):7} rows {verdict}", flush=True)
        if verdict != "ok":
            print("  columns", set(columns) ^ set(expected_columns), len(rows), len(expected))
            different = [(a, b) for a, b in zip(rows, expected) if a != b]
            for ours, theirs in different[:2]:
                print("  spark ", {c: v for c, v, w in zip(columns, ours, theirs) if v != w})
                print("  duckdb", {c: w for c, v, w in zip(columns, ours, theirs) if v != w})


if __name__ == "__main__":
    main()
