"""Run a registered query and its SQL side by side and compare rows and types."""

from __future__ import annotations

import math
from datetime import datetime

import duckdb
import pyarrow as pa

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value + 0.0
    if isinstance(value, datetime):
        return value.isoformat()
    return value


def rows_of(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return sorted((tuple(normal(v) for v in row) for row in zip(*columns)), key=repr)


def types_of(table: pa.Table) -> dict[str, str]:
    return {f.name: str(f.type).replace("large_", "") for f in table.schema}


def differences(expected: pa.Table, actual: pa.Table) -> str | None:
    if types_of(expected) != types_of(actual):
        return f"types: expected {types_of(expected)}, got {types_of(actual)}"
    if expected.num_rows != actual.num_rows:
        return f"rows: expected {expected.num_rows}, got {actual.num_rows}"
    left, right = rows_of(expected), rows_of(actual)
    if left != right:
        off = [(a, b) for a, b in zip(left, right) if a != b]
        return f"{len(off)} rows differ, first expected {off[0][0]}, got {off[0][1]} (columns {sorted(expected.column_names)})"
    return None
