"""Dates, numbers and translations as templates show them."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Directives of date formats.
DIRECTIVES = {"Y": "yyyy", "m": "MM", "d": "dd", "b": "MMM", "B": "MMMM", "e": "d", "H": "HH", "M": "mm", "S": "ss", "y": "yy", "j": "DDD", "A": "EEEE", "a": "EEE"}


def format_date(value: Column, template: str) -> Column:
    """A date by a template of % directives; text between them stays."""
    out, at = "", 0
    for hole in re.finditer(r"%(\w)", template):
        plain = template[at : hole.start()]
        out += (f"'{plain}'" if re.search("[A-Za-z]", plain) else plain) + DIRECTIVES[hole.group(1)]
        at = hole.end()
    plain = template[at:]
    return F.date_format(value, out + (f"'{plain}'" if re.search("[A-Za-z]", plain) else plain))


def at_least(value: Column, low: Column) -> Column:
    return F.greatest(value, low)


def at_most(value: Column, high: Column) -> Column:
    return F.least(value, high)


def divided_by(value: Column, by: int) -> Column:
    """Whole numbers divide to whole numbers, downwards."""
    return F.floor(value / by)


def modulo(value: Column, by: int) -> Column:
    """The sign follows the divisor."""
    return F.pmod(value, F.lit(by))


def to_int_or(text: Column, default: Column) -> Column:
    """Leading whole number of a text, else the default."""
    return F.coalesce(F.nullif(F.regexp_extract(text, r"^\s*([+-]?\d+)", 1), F.lit("")).try_cast("int"), default)


def without_trailing_zeros(amount: Column) -> Column:
    return F.regexp_replace(amount, r"[.,]0+$", "")


def unit_price(price: Column, unit: Column, value: Column) -> Column:
    """A price per unit: '1.00/kg', or '1.00/500g' where the reference isn't one unit."""
    return F.concat(price, F.lit("/"), F.when(value == 1, "").otherwise(value.cast("string")), unit)


def translate(texts: Mapping[str, str], key: Column, count: Column | None = None) -> Column:
    """The text of a dotted key; with a count its 'one' or 'other' form with the count filled in; a missing key is itself."""
    table = F.create_map(*(F.lit(x) for pair in sorted(texts.items()) for x in pair))
    if count is None:
        return F.coalesce(F.try_element_at(table, key), key)
    form = F.concat(key, F.when(count == 1, ".one").otherwise(".other"))
    return F.replace(F.coalesce(F.try_element_at(table, form), key), F.lit("{{ count }}"), count.cast("string"))
