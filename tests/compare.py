"""Run a registered query and its oracle and compare them value by value."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pyarrow as pa

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        if Path(f"{sf}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def kind(t: pa.DataType) -> str:
    if pa.types.is_integer(t):
        return str(t)
    if pa.types.is_string(t) or pa.types.is_large_string(t):
        return "string"
    if pa.types.is_timestamp(t):
        return "timestamp" + ("_tz" if t.tz else "")
    return str(t)


def cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return repr(v)


def canonical(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    return sorted(tuple(cell(v) for v in row) for row in zip(*[table[n].to_pylist() for n in names])) if names else []


def differences(spark_table: pa.Table, duck_table: pa.Table) -> list[str]:
    out = []
    a, b = sorted(spark_table.column_names), sorted(duck_table.column_names)
    if a != b:
        return [f"columns {a} != {b}"]
    for name in a:
        s, d = kind(spark_table.schema.field(name).type), kind(duck_table.schema.field(name).type)
        if s != d:
            out.append(f"type of {name}: {s} != {d}")
    if spark_table.num_rows != duck_table.num_rows:
        out.append(f"rows {spark_table.num_rows} != {duck_table.num_rows}")
    left, right = canonical(spark_table), canonical(duck_table)
    wrong = [(x, y) for x, y in zip(left, right) if x != y]
    if wrong:
        out.append(f"{len(wrong)} rows differ in {a}, first {wrong[0]}")
    return out
