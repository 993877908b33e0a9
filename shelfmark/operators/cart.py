"""Cart totals, discount codes and line prices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def totals(lines: DataFrame, by: Sequence[str], quantity: Column, line_price: Column) -> DataFrame:
    """items and the price before discounts, 0 where there is nothing."""
    zero = F.lit(0).cast("long")
    return lines.groupBy(*by).agg(F.coalesce(F.sum(quantity), zero).alias("items"), F.coalesce(F.sum(line_price), zero).alias("total_price"))


def discount_codes(cart_level: DataFrame, line_level: DataFrame) -> DataFrame:
    """cart_id, code: those of either level once (both have cart_id, type, code)."""
    both = cart_level.unionByName(line_level).filter("type = 'discount_code'")
    return both.select("cart_id", "code").distinct()


def add(lines: DataFrame, adds: DataFrame, keys: Sequence[str], quantity: str = "quantity") -> DataFrame:
    """The cart after adding: what is there already grows, the rest is appended. Quantities are summed before the shuffle."""
    both = lines.select(*keys, quantity).unionByName(adds.select(*keys, quantity))
    return both.groupBy(*keys).agg(F.sum(quantity).alias(quantity))


def visible_component_quantity(quantity: Column) -> Column:
    """A component's quantity is shown if there is more than one."""
    return F.when(quantity > 1, quantity)


def component_lines(lines: DataFrame, components: str) -> DataFrame:
    """A row for each component of a bundle; lines without components give none."""
    return lines.select(*(c for c in lines.columns if c != components), F.posexplode(components).alias("component_pos", "component"))
