"""Run a registered query and its oracle on the same tables and compare them."""

from __future__ import annotations

import datetime
from collections import Counter
from pathlib import Path

import duckdb


def tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """A private in-process DuckDB with one view per table."""
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return value + 0.0 if value else 0.0
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark_df, connection, sql: str) -> list[str]:
    """Empty if columns and rows (as multisets, values exact) agree."""
    relation = connection.sql(sql)
    expected_columns = relation.columns
    if sorted(spark_df.columns) != sorted(expected_columns):
        return [f"columns {sorted(spark_df.columns)} and {sorted(expected_columns)}"]
    expected = _rows(expected_columns, relation.fetchall())
    actual = _rows(spark_df.columns, [tuple(row) for row in spark_df.collect()])
    if not expected:
        return ["the oracle gives no rows"]
    only_spark, only_oracle = actual - expected, expected - actual
    if not only_spark and not only_oracle:
        return []
    return [
        f"{sum(only_spark.values())} rows only in Spark, e.g. {list(only_spark)[:3]}",
        f"{sum(only_oracle.values())} rows only in the oracle, e.g. {list(only_oracle)[:3]}",
    ]
