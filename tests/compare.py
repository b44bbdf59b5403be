"""Run a query and its SQL twin on the same tables and compare them as sorted rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


# Spark and DuckDB names of the types the results use.
SAME_TYPE = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp": "TIMESTAMP",
}


def assert_same(actual: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> int:
    expected = connection.execute(sql)
    types = {d[0]: str(d[1]) for d in expected.description}
    names = list(types)
    assert sorted(actual.columns) == sorted(names)
    assert {n: SAME_TYPE[t] for n, t in actual.dtypes} == types
    left = _rows(actual.columns, actual.collect())
    right = _rows(names, expected.fetchall())
    assert len(left) == len(right), f"{len(left)} rows, expected {len(right)}"
    different = [(a, b) for a, b in zip(left, right) if a != b]
    assert not different, f"{len(different)} rows differ, first {different[0]}"
    return len(left)
