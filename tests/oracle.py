"""Run a registered query and its oracle statement and compare the results."""

from __future__ import annotations

import math
import os

import duckdb

EXACT = bool(os.environ.get("EXACT"))

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return f"{value + 0.0:.6g}" if abs(value) >= 1e-9 else "0"
    if isinstance(value, int):
        return f"{float(value):.6g}" if abs(value) >= 10**6 else str(value)
    return str(value)


def _number(value):
    return float(value) if isinstance(value, (int, float)) and not isinstance(value, bool) else value


def compare(spark_rows: list[dict], oracle_rows: list[dict]) -> str | None:
    """None when both results hold the same rows, otherwise a short description."""
    if len(spark_rows) != len(oracle_rows):
        return f"{len(spark_rows)} rows instead of {len(oracle_rows)}"
    if not spark_rows:
        return None
    columns = sorted(spark_rows[0])
    if columns != sorted(oracle_rows[0]):
        return f"columns {columns} instead of {sorted(oracle_rows[0])}"

    def key(row):
        return tuple(_cell(_number(row[c])) for c in columns)

    left, right = sorted(spark_rows, key=key), sorted(oracle_rows, key=key)
    for a, b in zip(left, right):
        for c in columns:
            x, y = _number(a[c]), _number(b[c])
            if isinstance(x, float) and isinstance(y, float):
                if x != y and not math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9) or (EXACT and x != y):
                    return f"{c}: {x!r} instead of {y!r} in {a}"
            elif x != y:
                return f"{c}: {x!r} instead of {y!r} in {a}"
    return None


def check(spark, connection, name, query, sql, sf_dir) -> str | None:
    found = query(spark, sf_dir)
    plan = found._jdf.queryExecution().executedPlan().toString()
    for join in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        if join in plan:
            return f"the plan holds a {join}"
    rows = [r.asDict() for r in found.collect()]
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = [dict(zip(names, r)) for r in cursor.fetchall()]
    if not rows and not expected and sorted(found.columns) != sorted(names):
        return f"columns {found.columns} instead of {names}"
    types = dict(found.dtypes)
    for d in cursor.description:
        kind = str(d[1])
        if kind == "HUGEINT" or kind.startswith("DECIMAL"):
            return f"oracle column {d[0]} is {kind}"
        if (kind in ("DOUBLE", "FLOAT")) != (types.get(d[0]) in ("double", "float")):
            return f"column {d[0]} is {types.get(d[0])}, oracle {kind}"
        if kind in ("BIGINT", "INTEGER") and types.get(d[0]) != {"BIGINT": "bigint", "INTEGER": "int"}[kind]:
            return f"column {d[0]} is {types.get(d[0])}, oracle {kind}"
    return compare(rows, expected)
