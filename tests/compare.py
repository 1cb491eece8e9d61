"""Run registered queries beside their SQL and compare rows, names and types."""

from __future__ import annotations

import glob
import math
import os
from datetime import date, datetime

import duckdb

SPARK_KINDS = {"tinyint": "int", "smallint": "int"}
DUCK_KINDS = {
    "VARCHAR": "string", "INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double",
    "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp",
}


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"create view {name} as select * from '{path}'")
    return connection


def _key(value):
    if value is None:
        return (0, "")
    if isinstance(value, float):
        return (1, "nan" if math.isnan(value) else repr(value))
    if isinstance(value, datetime):
        return (1, value.replace(tzinfo=None).isoformat())
    if isinstance(value, date):
        return (1, value.isoformat())
    return (1, f"{type(value).__name__}:{value}")


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_key(row[i]) for i in order) for row in rows)


def compare(spark_df, connection, sql: str) -> list[str]:
    """Differences in words; empty when rows, column names and types are equal."""
    result = connection.sql(sql)
    names, kinds = result.columns, [DUCK_KINDS.get(str(t), str(t)) for t in result.types]
    problems = []
    duck_schema = sorted(zip(names, kinds))
    spark_schema = sorted((f.name, f.dataType.simpleString()) for f in spark_df.schema)
    if duck_schema != spark_schema:
        problems.append(f"schema: {[p for p in zip(spark_schema, duck_schema) if p[0] != p[1]]}"
                        f" {len(spark_schema)}/{len(duck_schema)}")
    theirs = result.fetchall()
    ours = [tuple(r) for r in spark_df.collect()]
    if len(ours) != len(theirs):
        problems.append(f"rows: {len(ours)} instead of {len(theirs)}")
    if sorted(spark_df.columns) == sorted(names):
        a, b = _rows(spark_df.columns, ours), _rows(names, theirs)
        if a != b:
            only_a = [r for r in a if r not in set(b)][:2]
            only_b = [r for r in b if r not in set(a)][:2]
            problems.append(f"values: ours {only_a} theirs {only_b}")
    return problems
