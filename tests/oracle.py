"""Run a query's SQL text in DuckDB and compare it with the Spark result."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

DATA = Path("/root/testdata")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(repr(value))
    if hasattr(value, "tzinfo") and value.tzinfo is not None:
        return value.replace(tzinfo=None)
    return value


def sort_key(row):
    return tuple((v is None, str(v)) for v in row)


def spark_rows(df: DataFrame) -> tuple[list[str], list[tuple]]:
    columns = sorted(df.columns)
    rows = [tuple(plain(r[c]) for c in columns) for r in df.collect()]
    return columns, sorted(rows, key=sort_key)


def sql_rows(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    with connect(sf_dir) as connection:
        result = connection.execute(sql)
        names = [d[0] for d in result.description]
        fetched = result.fetchall()
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(plain(r[i]) for i in order) for r in fetched]
    return [names[i] for i in order], sorted(rows, key=sort_key)
