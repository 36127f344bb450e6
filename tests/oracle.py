"""Run a query in Spark and its SQL in DuckDB, and compare all values."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def canonical(value):
    if value is None or isinstance(value, (bool, int, str)):
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    raise TypeError(f"unexpected type in a result: {type(value)}")


def sort_key(row):
    return tuple((value is not None, str(type(value)), value) for value in row)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(canonical(row[i]) for i in order) for row in rows), key=sort_key)


def difference(spark_frame, connection, sql: str) -> str | None:
    """None when both agree in columns, row count and values."""
    columns = spark_frame.columns
    ours = rows_of(columns, [tuple(row) for row in spark_frame.collect()])
    result = connection.execute(sql)
    names = [item[0] for item in result.description]
    theirs = rows_of(names, result.fetchall())
    if sorted(columns) != sorted(names):
        return f"columns {sorted(columns)} != {sorted(names)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    for one, other in zip(ours, theirs):
        if one != other:
            return f"{sorted(columns)}: {one} != {other}"
        if [type(v) for v in one] != [type(v) for v in other]:
            return f"types differ in {one} and {other}"
    return None
