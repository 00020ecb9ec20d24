"""Row-by-row comparison of a Spark query with its SQL twin."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def sql_rows(folder: str, sql: str) -> tuple[list[str], Counter]:
    with duckdb.connect() as db:
        for name in TABLES:
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
        cursor = db.execute(sql)
        names = [column[0] for column in cursor.description]
        return _bag(names, cursor.fetchall())


def spark_rows(df) -> tuple[list[str], Counter]:
    return _bag(df.columns, [tuple(row) for row in df.collect()])


def _bag(names, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(
        tuple(_value(row[i]) for i in order) for row in rows)


def _value(value):
    """Types count: 1 and 1.0 and True are different answers."""
    if isinstance(value, float) and math.isnan(value):
        return "float", "nan"
    return type(value).__name__, value
