"""Comparing a query's rows with those of its SQL in DuckDB. For tests and the check tool."""

from __future__ import annotations

import os
from collections import Counter
from datetime import datetime
from decimal import Decimal

from pyspark.sql import DataFrame

Rows = tuple[list[str], list[tuple]]


def register_tables(con, sf_dir: str) -> None:
    """Each Parquet file of the folder as a view."""
    for file in sorted(os.listdir(sf_dir)):
        if file.endswith(".parquet"):
            con.execute(f"CREATE OR REPLACE VIEW {file[:-8]} AS SELECT * FROM '{sf_dir}/{file}'")


def _plain(value):
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, Decimal):
        return int(value)
    if isinstance(value, datetime):
        return value.isoformat()
    return value


def _sorted_columns(names: list[str], rows: list[tuple]) -> Rows:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], [tuple(_plain(r[i]) for i in order) for r in rows]


def spark_rows(df: DataFrame) -> Rows:
    """All rows of a small result, columns by name."""
    return _sorted_columns(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql: str) -> Rows:
    """The rows of a SQL query, columns by name."""
    found = con.execute(sql)
    return _sorted_columns([d[0] for d in found.description], found.fetchall())


def same_rows(mine: Rows, theirs: Rows) -> str:
    """``ok`` and the number of rows, or what differs."""
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} and {theirs[0]}"
    a, b = Counter(mine[1]), Counter(theirs[1])
    if a == b:
        return f"ok {len(mine[1])} rows"
    only_a, only_b = a - b, b - a
    return (
        f"{len(mine[1])} and {len(theirs[1])} rows; only here {sum(only_a.values())} {list(only_a)[:2]}; "
        f"only in SQL {sum(only_b.values())} {list(only_b)[:2]}"
    )
