"""Compare a Spark result with the oracle's result on the same parquet files."""

from __future__ import annotations

import math
from decimal import Decimal

import duckdb

from waybill.sources import TABLES


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{directory}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        value = float(value)
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(df, con, sql: str) -> str | None:
    """None if equal, else a description of the first differences."""
    mine = rows_of(df.columns, [tuple(x) for x in df.collect()])
    cursor = con.execute(sql)
    theirs = rows_of([c[0] for c in cursor.description], cursor.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} != {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"rows {len(mine[1])} != {len(theirs[1])}; {mine[1][:2]} / {theirs[1][:2]}"
    wrong = [(a, b) for a, b in zip(mine[1], theirs[1]) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(mine[1])} rows differ, columns {mine[0]}: {wrong[:3]}"
    return None
