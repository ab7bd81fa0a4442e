"""Compare every registered query with its SQL: ``python tests/parity.py SF_DIR [names]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def canonical(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


_KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def differences(spark_df, connection, sql: str) -> str | None:
    """None when columns, types and rows agree, else a description."""
    result = connection.sql(sql)
    ours = {n: _KINDS.get(t, t) for n, t in spark_df.dtypes}
    theirs = {n: str(t) for n, t in zip(result.columns, result.types)}
    if ours != theirs:
        return f"schema {ours} vs {theirs}"
    left = canonical(spark_df.columns, spark_df.collect())
    right = canonical(result.columns, result.fetchall())
    if len(left) != len(right):
        return f"rows {len(left)} vs {len(right)}"
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(wrong)} of {len(left)} rows differ, first {wrong[0]}"[:700] if wrong else None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = sys.argv[1]
    connection = connect(sf_dir)
    for name, sql in entry.oracle_sql().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            problem = differences(entry.queries()[name](spark, sf_dir), connection, sql)
        except Exception as error:
            problem = f"{type(error).__name__} {str(error)[:700]}"
        print(f"{'ok  ' if problem is None else 'FAIL'} {name:26s} {time.time() - start:6.2f}s {problem or ''}", flush=True)
