"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            connection.sql(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else value
    return value


def rows_by_name(columns: list[str], rows: list[tuple]) -> Counter:
    places = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in places) for row in rows)


def assert_same(spark_df, relation) -> int:
    assert sorted(spark_df.columns) == sorted(relation.columns)
    kinds = {
        "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    }
    expected_kinds = dict(zip(relation.columns, map(str, relation.types), strict=True))
    for name, kind in spark_df.dtypes:
        assert kinds.get(kind, kind) == expected_kinds[name], (name, kind, expected_kinds[name])
    found = rows_by_name(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    expected = rows_by_name(relation.columns, relation.fetchall())
    extra, missing = found - expected, expected - found
    assert not extra and not missing, (list(extra.items())[:5], list(missing.items())[:5])
    return sum(found.values())
