"""Spark against DuckDB: same columns, types and rows in any order."""

from __future__ import annotations

import datetime
import math
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

# Names of the same type in both engines.
_TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
    "DATE": "date", "BOOLEAN": "boolean",
}


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def _bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def duck(tables: dict[str, str] | None = None) -> duckdb.DuckDBPyConnection:
    """A connection with a view per parquet path."""
    con = duckdb.connect()
    for name, path in (tables or {}).items():
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    types = {d[0]: _TYPES.get(str(d[1]), str(d[1])) for d in cursor.description}
    theirs = _bag(names, cursor.fetchall())
    ours = _bag(df.columns, [tuple(r) for r in df.collect()])
    found = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    for field in df.schema.fields:
        if field.dataType.simpleString() != types[field.name]:
            found.append(f"{field.name}: {field.dataType.simpleString()} against {types[field.name]}")
    if ours != theirs:
        found.append(
            f"{sum(ours.values())} rows against {sum(theirs.values())}; "
            f"only Spark {list((ours - theirs).items())[:3]}, "
            f"only DuckDB {list((theirs - ours).items())[:3]}"
        )
    return found
