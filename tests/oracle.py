"""Comparing a query with its SQL, value by value."""

from __future__ import annotations

import math

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

_SPARK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _sorted(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(row[i] for i in order) for row in rows]
    return sorted(picked, key=lambda r: tuple((v is None, str(v)) for v in r))


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs: types, number of rows, values. Empty if nothing does."""
    relation = con.sql(sql)
    spark_types = {n: _SPARK_TYPES.get(t, t) for n, t in df.dtypes}
    sql_types = {n: str(t) for n, t in zip(relation.columns, relation.types, strict=True)}
    found = []
    if spark_types != sql_types:
        found.append(f"types {spark_types} != {sql_types}")
        if sorted(spark_types) != sorted(sql_types):
            return found
    left = _sorted([tuple(r) for r in df.collect()], df.columns)
    right = _sorted(relation.fetchall(), relation.columns)
    if len(left) != len(right):
        found.append(f"{len(left)} rows != {len(right)}")
    for a, b in zip(left, right, strict=False):
        if a != b and not all(
            x == y or (isinstance(x, float) and isinstance(y, float) and math.isnan(x) and math.isnan(y))
            for x, y in zip(a, b, strict=True)
        ):
            found.append(f"{a} != {b}")
            break
    return found
