"""Runs a query and its SQL side by side and reports the first difference."""

from __future__ import annotations

import math

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "\0"
    if isinstance(value, float):
        return repr(round(value, 9))
    return str(value)


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(result: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both give the same columns and rows."""
    answer = con.sql(sql)
    if sorted(result.columns) != sorted(answer.columns):
        return f"columns {sorted(set(result.columns) ^ set(answer.columns))}"
    kinds = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE"}
    given = dict(zip(answer.columns, map(str, answer.types)))
    for name, kind in result.dtypes:
        if kind in kinds and given[name] not in (kinds[kind], '"NULL"'):
            return f"type of {name}: {kind} and {given[name]}"
    ours, theirs = _rows(result.columns, result.collect()), _rows(answer.columns, answer.fetchall())
    if len(ours) != len(theirs):
        return f"{len(ours)} rows and {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            names = sorted(result.columns)
            return "; ".join(f"{n}: {x!r} and {y!r}" for n, x, y in zip(names, a, b) if x != y)
    return None
