"""Array filters of templates as Column expressions over arrays of structs (or of plain values, where no field is named)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pluck(rows: Column, field: str) -> Column:
    return F.transform(rows, lambda r: r[field])


def where(rows: Column, field: str, value: Column) -> Column:
    return F.filter(rows, lambda r: r[field].eqNullSafe(value))


def where_set(rows: Column, field: str) -> Column:
    """Rows whose field is there."""
    return F.filter(rows, lambda r: r[field].isNotNull())


def where_true(rows: Column, field: str) -> Column:
    """Rows whose boolean field is true."""
    return F.filter(rows, lambda r: F.coalesce(r[field], F.lit(False)))


def reject(rows: Column, field: str, value: Column) -> Column:
    """All rows but those with this value; rows without one stay."""
    return F.filter(rows, lambda r: ~r[field].eqNullSafe(value))


def find(rows: Column, field: str, value: Column) -> Column:
    """The first match, or null."""
    return F.get(where(rows, field, value), F.lit(0))


def find_index(rows: Column, field: str, value: Column) -> Column:
    """Where the first match stands, from 0, or null."""
    return F.nullif(F.array_position(F.transform(rows, lambda r: r[field].eqNullSafe(value)), True), F.lit(0)) - 1


def has(rows: Column, field: str, value: Column) -> Column:
    return F.exists(rows, lambda r: r[field].eqNullSafe(value))


def total(rows: Column, field: str) -> Column:
    """The field's sum; nulls count 0."""
    return F.aggregate(rows, F.lit(0).cast("long"), lambda a, r: a + F.coalesce(r[field], F.lit(0)))


def sort_natural(values: Column) -> Column:
    """Sorted without regard to case; equal ones by their own order."""
    return F.transform(F.array_sort(F.transform(values, lambda v: F.struct(F.lower(v).alias("k"), v.alias("v")))), lambda s: s["v"])


def first(values: Column) -> Column:
    return F.get(values, F.lit(0))


def last(values: Column) -> Column:
    return F.try_element_at(values, F.lit(-1))


def lookahead(values: Column) -> Column:
    """Each value with the one after it (null for the last)."""
    return F.transform(values, lambda v, i: F.struct(v.alias("value"), F.get(values, i + 1).alias("next")))
