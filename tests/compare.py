"""Rows of Spark and of DuckDB in one form."""

from __future__ import annotations

import decimal


def plain(value: object) -> object:
    if isinstance(value, decimal.Decimal):
        return float(value)
    return round(value, 6) if isinstance(value, float) else value


def spark_rows(df) -> tuple[list[str], list[str]]:
    names = sorted(df.columns)
    return names, sorted(repr(tuple(plain(r[n]) for n in names)) for r in df.collect())


def duck_rows(con, sql: str) -> tuple[list[str], list[str]]:
    found = con.sql(sql)
    held = [d[0] for d in found.description]
    names = sorted(held)
    return names, sorted(repr(tuple(plain(r[held.index(n)]) for n in names)) for r in found.fetchall())
