"""Result comparison between Spark and DuckDB: same columns, same rows, any order."""

from __future__ import annotations

from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events".split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{Path(folder) / table}.parquet')")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return repr(value + 0.0)
    if isinstance(value, Decimal):
        return f"decimal {value}"
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    return value


def as_bag(columns, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def spark_bag(df):
    return as_bag(df.columns, [tuple(r) for r in df.collect()])


def duck_bag(con, sql):
    result = con.execute(sql)
    return as_bag([c[0] for c in result.description], result.fetchall())
