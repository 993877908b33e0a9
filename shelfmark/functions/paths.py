"""Paths into values of unknown shape, which are held as VARIANT: what is missing, beyond an end or of another kind is null."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_NAME = r"[A-Za-z_$][A-Za-z0-9_$]*"
_STEP = re.compile(rf"\.(?P<name>{_NAME}|\d+)|\[(?P<index>\d+)\]|\[(?P<quote>['\"])(?P<quoted>[^'\"\]]*)(?P=quote)\]|\[(?P<path>{_NAME}(?:\.{_NAME})*)\]")
_HEAD = re.compile(_NAME)

#: Kinds of values: undefined (nothing there), null, boolean, number, string, object, array.
_NUMBERS = ("TINYINT", "SMALLINT", "INT", "BIGINT", "FLOAT", "DOUBLE")


def parsed(source: Column) -> Column:
    """Text as a VARIANT; null if it isn't JSON."""
    return F.try_parse_json(source)


def _member(value: Column, name: Column) -> Column:
    """A member of an object, or an array's element at a place."""
    quoted = F.concat(F.lit("$['"), name, F.lit("']"))
    by_name = F.try_variant_get(value, quoted, "variant")
    return F.when(name.rlike(r"^\d+$"), F.coalesce(F.try_variant_get(value, F.concat(F.lit("$["), name, F.lit("]")), "variant"), by_name)).otherwise(by_name)


def at(value: Column, path: str) -> Column:
    """The VARIANT at a path such as ``user.tags[0]``, ``user['name']`` or ``tags[user.place]``, whose index is a path as well.

    A path that isn't one leads nowhere: it gives null, as a missing member does.
    """
    head = _HEAD.match(path.strip())
    if not head:
        return F.lit(None).cast("variant")
    out, rest = _member(value, F.lit(head[0])), path.strip()[head.end() :]
    while rest:
        step = _STEP.match(rest)
        if not step:
            return F.lit(None).cast("variant")
        fixed = next((step[g] for g in ("name", "index", "quoted") if step[g] is not None), None)
        out = _member(out, text(at(value, step["path"])) if fixed is None else F.lit(fixed))
        rest = rest[step.end() :]
    return out


def text(value: Column) -> Column:
    """A VARIANT as text; objects and arrays as JSON."""
    return F.try_variant_get(value, "$", "string")


def kind(value: Column) -> Column:
    name = F.schema_of_variant(value)
    known = F.when(name == "VOID", "null").when(name == "STRING", "string").when(name == "BOOLEAN", "boolean").when(name.isin(*_NUMBERS) | name.startswith("DECIMAL"), "number")
    return F.coalesce(known.when(name.startswith("ARRAY"), "array").when(name.startswith("OBJECT"), "object"), F.lit("undefined"))


def _number(value: Column) -> Column:
    return F.try_variant_get(value, "$", "double")


def same(a: Column, b: Column) -> Column:
    """Loosely equal: null and undefined are one; a number equals a text or boolean that stands for it; objects and arrays equal nothing."""
    none = lambda x: kind(x).isin("undefined", "null")
    deep = lambda x: kind(x).isin("object", "array")
    texts = (kind(a) == "string") & (kind(b) == "string")
    return F.when(none(a) | none(b), none(a) & none(b)).when(deep(a) | deep(b), False).when(texts, text(a) == text(b)).otherwise(F.coalesce(_number(a) == _number(b), F.lit(False)))


def identical(a: Column, b: Column) -> Column:
    """Strictly equal: of one kind as well."""
    return (kind(a) == kind(b)) & (kind(a).isin("undefined", "null") | same(a, b))


def truthy(value: Column) -> Column:
    """Not undefined, null, false, 0 or an empty text."""
    empty = F.when(kind(value) == "string", text(value) == "").when(kind(value).isin("boolean", "number"), _number(value) == 0).otherwise(F.lit(False))
    return ~kind(value).isin("undefined", "null") & ~empty


def literal(value: object) -> Column:
    """A constant to compare with: text, number, boolean or None (null)."""
    return F.parse_json(F.lit(json.dumps(value)))
