"""Run a registered query and its SQL counterpart, and compare them row by row."""

from __future__ import annotations

import duckdb
from pyspark.sql import DataFrame

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
SAME_TYPE = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double",
    "DATE": "date", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both sides agree in columns, types and rows; else what differs."""
    cursor = con.execute(sql)
    expected_types = {c[0]: SAME_TYPE.get(str(c[1]), str(c[1])) for c in cursor.description}
    found_types = dict(df.dtypes)
    if expected_types != found_types:
        odd = set(expected_types.items()) ^ set(found_types.items())
        return f"columns differ: {sorted(odd)}"
    names = [c[0] for c in cursor.description]
    expected = sorted(map(repr, cursor.fetchall()))
    found = sorted(repr(tuple(row)) for row in df.select(*names).collect())
    if expected == found:
        return None
    extra = [r for r in found if r not in set(expected)][:3]
    missing = [r for r in expected if r not in set(found)][:3]
    return f"{len(found)} rows against {len(expected)}; only here {extra}, only there {missing}"
