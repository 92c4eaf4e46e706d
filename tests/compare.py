"""Run a registered query and its SQL oracle on the same files and compare the results."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pyarrow as pa

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        if Path(f"{root}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{root}/{name}.parquet')")
    return con


def kind(t: pa.DataType) -> str:
    if pa.types.is_timestamp(t):
        return "timestamp" if t.tz is None else "timestamptz"
    if pa.types.is_string(t) or pa.types.is_large_string(t):
        return "string"
    return str(t)


def rows_of(columns: dict[str, list]) -> list[tuple]:
    def cell(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else v + 0.0
        if isinstance(v, list):
            return tuple(cell(x) for x in v)
        if hasattr(v, "replace") and getattr(v, "tzinfo", None):
            return v.replace(tzinfo=None)
        return v

    names = sorted(columns)
    return sorted(zip(*[[cell(v) for v in columns[n]] for n in names]), key=repr)


def differences(spark_table: pa.Table, oracle: pa.Table) -> list[str]:
    """Empty when columns, types, row count and all values agree."""
    found = []
    mine = {f.name: kind(f.type) for f in spark_table.schema}
    theirs = {f.name: kind(f.type) for f in oracle.schema}
    if mine != theirs:
        gap = {n: (mine.get(n), theirs.get(n)) for n in {*mine, *theirs} if mine.get(n) != theirs.get(n)}
        found.append(f"schema (spark, oracle): {gap}")
    if spark_table.num_rows != oracle.num_rows:
        found.append(f"rows: {spark_table.num_rows} vs {oracle.num_rows}")
    if set(mine) == set(theirs):
        a, b = rows_of(spark_table.to_pydict()), rows_of(oracle.to_pydict())
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        if bad:
            found.append(f"{len(bad)} rows differ, first: {bad[0]}")
    return found


def oracle_table(con: duckdb.DuckDBPyConnection, sql: str) -> pa.Table:
    result = con.execute(sql)
    for method in ("to_arrow_table", "fetch_arrow_table", "arrow"):
        if hasattr(result, method):
            table = getattr(result, method)()
            return table.read_all() if hasattr(table, "read_all") else table
    raise RuntimeError("this DuckDB cannot return Arrow tables")
