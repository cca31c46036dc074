"""Compare a Spark result with the DuckDB result of its SQL."""

from __future__ import annotations

import math
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(picked, key=repr)


def compare(df, con, sql):
    """(column names, rows) of both sides."""
    spark_side = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    duck_side = rows_of([c[0] for c in result.description], result.fetchall())
    return spark_side, duck_side
