"""Runs a query in Spark and its SQL in DuckDB and compares the rows."""

from __future__ import annotations

import glob
import math
import os

import duckdb


SQL_TYPES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "boolean": "BOOLEAN",
    "double": "DOUBLE", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(df, connection, sql: str) -> str | None:
    """None when names, types and rows are equal, else what differs."""
    relation = connection.sql(sql)
    sql_names = relation.columns
    sql_types = dict(zip(sql_names, map(str, relation.types)))
    our_types = {name: SQL_TYPES[kind] for name, kind in df.dtypes}
    if our_types != sql_types:
        return f"types {our_types} / {sql_types}"
    ours = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    theirs = _sorted_rows(sql_names, relation.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} / {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"rows {len(ours[1])} / {len(theirs[1])}"
    for a, b in zip(ours[1], theirs[1]):
        if a != b:
            return f"{a} / {b}"
    return None
