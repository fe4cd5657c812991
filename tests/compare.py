"""Comparing a Spark result with the SQL result of DuckDB."""

from __future__ import annotations

from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

# The given tables.
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def _sorted(columns: list[str], rows: list) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def differences(result: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty if both results have the same columns and the same rows, in any order."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    expected, rows = found.fetchall(), [tuple(r) for r in result.collect()]
    if sorted(names) != sorted(result.columns):
        return f"columns {sorted(result.columns)}, SQL {sorted(names)}"
    if len(rows) != len(expected):
        return f"{len(rows)} rows, SQL {len(expected)}"
    ours, theirs = _sorted(result.columns, rows), _sorted(names, expected)
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else ""
