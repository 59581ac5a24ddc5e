"""Runs registered queries next to their SQL in DuckDB and compares all rows."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(
        (tuple(_plain(row[i]) for i in order) for row in rows), key=lambda r: tuple((v is None, str(v)) for v in r)
    )


def difference(spark_df, con, sql: str) -> str | None:
    """What differs, or None."""
    theirs = con.execute(sql)
    columns, expected = rows_of([d[0] for d in theirs.description], theirs.fetchall())
    mine, got = rows_of(spark_df.columns, spark_df.collect())
    if mine != columns:
        return f"columns {mine} != {columns}"
    if len(got) != len(expected):
        return f"{len(got)} rows != {len(expected)}"
    for a, b in zip(got, expected):
        if a != b or any(type(x) is not type(y) for x, y in zip(a, b)):
            return f"{a} != {b}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            df = query(spark, sf)
            if name in entry.oracle_sql():
                result = difference(df, con, entry.oracle_sql()[name]) or "ok"
            else:
                result = f"rows {df.count()}"
        except Exception as e:  # report every query, whatever happens to one
            result = f"FAILED {type(e).__name__} {str(e)[:600]}"
        print(f"{name:36s} {time.time() - started:6.1f}s  {result}", flush=True)
