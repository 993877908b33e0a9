"""Money in whole minor units: parsing and formatting without floating point."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Decimals of currencies that don't have two.
DECIMALS = {
    "BHD": 3, "BIF": 0, "BYR": 0, "CLF": 4, "CLP": 0, "DJF": 0, "GNF": 0, "IQD": 3, "ISK": 0, "JOD": 3, "JPY": 0, "KMF": 0, "KRW": 0, "KWD": 3,
    "LYD": 3, "MRO": 5, "OMR": 3, "PYG": 0, "RWF": 0, "TND": 3, "UGX": 0, "UYI": 0, "UYW": 4, "VND": 0, "VUV": 0, "XAF": 0, "XAG": 0, "XAU": 0,
    "XBA": 0, "XBB": 0, "XBC": 0, "XBD": 0, "XDR": 0, "XOF": 0, "XPD": 0, "XPF": 0, "XPT": 0, "XSU": 0, "XTS": 0, "XUA": 0,
}
USUAL = 2

#: Placeholder -> (thousands separator, decimal separator, are decimals shown).
SEPARATORS = {
    "amount": (",", ".", True),
    "amount_no_decimals": (",", ".", False),
    "amount_with_comma_separator": (".", ",", True),
    "amount_no_decimals_with_comma_separator": (".", ".", False),
    "amount_no_decimals_with_space_separator": (" ", ".", False),
    "amount_with_space_separator": (" ", ",", True),
    "amount_with_period_and_space_separator": (" ", ".", True),
    "amount_with_apostrophe_separator": ("'", ".", True),
}


def decimals(currency: Column) -> Column:
    table = F.create_map(*(F.lit(x) for pair in DECIMALS.items() for x in pair))
    return F.coalesce(F.try_element_at(table, F.upper(currency)), F.lit(USUAL))


def parse_money(value: Column, currency: Column) -> Column:
    """Minor units of whatever was typed; null without a digit. Signs are passed over.

    Digits come in groups; the last of several is the fraction if it has no more digits than the currency.
    """
    groups = F.regexp_extract_all(value, F.lit("[0-9]+"), F.lit(0))
    places, last = decimals(currency), F.try_element_at(groups, F.lit(-1))
    split = (places > 0) & (F.size(groups) > 1) & (F.length(last) <= places)
    whole = F.array_join(F.when(split, F.slice(groups, 1, F.size(groups) - 1)).otherwise(groups), "")
    fraction = F.when(split, F.rpad(last, places, F.lit("0"))).otherwise(F.repeat(F.lit("0"), places))
    return F.when(F.size(groups) > 0, F.concat(whole, fraction).cast("long"))


def parse_money_or(value: Column, fallback: Column, currency: Column) -> Column:
    """What was typed, else what the fallback says, else 0."""
    return F.coalesce(parse_money(value, currency), parse_money(fallback, currency), F.lit(0).cast("long"))


def format_amount(minor: Column, currency: Column, thousands: str, point: str, shown: bool) -> Column:
    """Digits grouped by three; without decimals halves are rounded away from zero before grouping."""
    places = decimals(currency)
    scale = F.pow(F.lit(10), places).cast("long")
    size = F.abs(minor)
    over = size if shown else size + (scale - scale % 2) / 2  # half a unit more, then down
    over = over.cast("long")
    digits = F.format_number(((over - over % scale) / scale).cast("decimal(20,0)"), 0)
    grouped = F.replace(digits, F.lit(","), F.lit(thousands))
    fraction = F.lpad((size % scale).cast("string"), places, F.lit("0"))
    text = F.when(places > 0, F.concat(grouped, F.lit(point), fraction)).otherwise(grouped) if shown else grouped
    return F.concat(F.when(minor < 0, "-").otherwise(""), text)


def format_money(minor: Column, template: str, currency: Column) -> Column:
    """A template with {{ placeholders }}; unknown ones are like amount, currency is the code itself."""
    parts, at = [], 0
    for hole in re.finditer(r"{{\s*(\w+)\s*}}", template):
        parts.append(F.lit(template[at : hole.start()]))
        name = hole.group(1)
        parts.append(currency if name == "currency" else format_amount(minor, currency, *SEPARATORS.get(name, SEPARATORS["amount"])))
        at = hole.end()
    return F.concat(*parts, F.lit(template[at:]))
