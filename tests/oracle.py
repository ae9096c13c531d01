"""Compare a Spark result with DuckDB's result for the equivalent SQL."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


_SPARK_NAMES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def spark_types(df: DataFrame) -> dict[str, str]:
    return {f.name: _SPARK_NAMES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when columns, types, row count and values agree."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    wanted = rows_of(names, result.fetchall())
    found_types = spark_types(df)
    problems = []
    if sorted(found_types) != sorted(types):
        return [f"columns {sorted(found_types)} vs {sorted(types)}"]
    problems += [f"type of {c}: {found_types[c]} vs {types[c]}" for c in types if found_types[c] != types[c]]
    found = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if len(found) != len(wanted):
        problems.append(f"rows {len(found)} vs {len(wanted)}")
    bad = [(a, b) for a, b in zip(found, wanted) if a != b]
    if bad:
        problems.append(f"{len(bad)} rows differ, first: {bad[0]}")
    return problems
