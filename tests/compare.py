"""Two result sets as sorted lists of plain values, columns by name."""

from __future__ import annotations

import datetime
import decimal
import math


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, datetime.date) and not isinstance(value, datetime.datetime):
        return str(value)
    return value


def rows(columns: list[str], data) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(row[i]) for i in order) for row in data]
    return sorted(out, key=repr)


def spark_rows(frame) -> tuple[list[str], list[tuple]]:
    return sorted(frame.columns), rows(frame.columns, frame.collect())


def duck_rows(sql: str, folder: str) -> tuple[list[str], list[tuple]]:
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{folder}/events.parquet')")
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    return sorted(names), rows(names, result.fetchall())
