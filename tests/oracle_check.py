"""Compare a registered query with its SQL: columns, number of rows and values, in any order."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, decimal.Decimal, float)):
        number = float(value)
        return "nan" if math.isnan(number) else number
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def sorted_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), sorted_rows(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return sorted(columns), sorted_rows(columns, cursor.fetchall())


def difference(df, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    have, rows = spark_rows(df)
    want, expected = duck_rows(con, sql)
    if have != want:
        return f"columns: extra {sorted(set(have) - set(want))}, missing {sorted(set(want) - set(have))}"
    if len(rows) != len(expected):
        return f"rows: {len(rows)} instead of {len(expected)}"
    for got, exp in zip(rows, expected):
        if got != exp:
            cells = [(c, g, e) for c, g, e in zip(have, got, exp) if g != e]
            return f"values: (column, got, expected) {cells[:5]}"
    return None
