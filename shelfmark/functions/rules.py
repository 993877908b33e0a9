"""Business rules as Column expressions. A comparison with null counts as false, as templates have it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def truly(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def default_to(value: Column, other: Column) -> Column:
    """Null and the empty string give the other value (coalesce keeps the empty string)."""
    return F.when(value.isNull() | (value == ""), other).otherwise(value)


def default_flag(value: Column, other: Column) -> Column:
    """Null and false give the other value."""
    return F.when(value.isNull() | ~value, other).otherwise(value)


def is_blank(value: Column) -> Column:
    return F.trim(F.coalesce(value, F.lit(""))) == ""


def sale_flag(price: Column, compare_at: Column) -> Column:
    return truly(compare_at > price)


def badge(available: Column, on_sale: Column) -> Column:
    return F.when(~truly(available), "sold_out").when(truly(on_sale), "sale").otherwise("none")


def inventory_status(managed: Column, quantity: Column, policy: Column, threshold: Column, exists: Column) -> Column:
    stocked = F.when(truly(quantity > 0), F.when(truly(quantity <= threshold), "low").otherwise("in_stock"))
    backorder = F.when(truly(policy == "continue"), "in_stock").otherwise("out_of_stock")
    return F.when(truly(managed), F.coalesce(stocked, backorder)).otherwise(F.when(truly(exists), "in_stock").otherwise("out_of_stock"))


def tier_price(breaks: Column, base: Column, quantity: Column) -> Column:
    """The last break, in array order, that the quantity reaches; else the base price."""
    return F.aggregate(breaks, base, lambda price, b: F.when(quantity >= b["minimum_quantity"], b["price"]).otherwise(price))


def tier_price_descending(breaks: Column, quantity: Column) -> Column:
    """The highest break that the quantity reaches; below all of them the lowest one."""
    down = F.reverse(F.array_sort(breaks))
    reached = F.filter(down, lambda b: quantity >= b["minimum_quantity"])
    return F.coalesce(F.get(reached, F.lit(0)), F.element_at(down, -1))["price"]


def active_tier(breaks: Column, minimum: Column, quantity: Column) -> Column:
    """0 for the base row, i for the i-th break, null below the minimum. Every break but the last ends at the next."""
    last = F.size(breaks)
    inside = F.transform(
        breaks,
        lambda b, i: truly((quantity >= b["minimum_quantity"]) & ((i + 1 == last) | (quantity < F.get(breaks, i + 1)["minimum_quantity"]))),
    )
    base = truly((quantity >= F.coalesce(minimum, F.lit(1))) & (quantity < F.get(breaks, F.lit(0))["minimum_quantity"]))
    return F.when(base, 0).otherwise(F.nullif(F.array_position(inside, True), F.lit(0)).cast("int"))


def has_quantity_rule(minimum: Column, increment: Column, maximum: Column) -> Column:
    return truly(minimum > 1) | truly(increment > 1) | maximum.isNotNull()


def effective_max(minimum: Column, maximum: Column, in_cart: Column) -> Column:
    return F.when(maximum.isNotNull(), F.greatest(maximum - in_cart, minimum))


def snap_quantity(value: Column, minimum: Column, step: Column, most: Column) -> Column:
    """Down to the grid, then into [minimum, most]; no most is no bound."""
    snapped = F.when((value - minimum) % step != 0, minimum + (F.floor((value - minimum) / step) * step).cast("int")).otherwise(value)
    return F.greatest(minimum, F.least(most, snapped))  # least() passes over a null bound


def step_quantity(value: Column, minimum: Column, step: Column, most: Column, times: int) -> Column:
    return F.least(most, F.greatest(minimum, value + step * times))


def can_add(value: Column, maximum: Column, in_cart: Column) -> Column:
    return ~truly(in_cart + value > maximum)


def clamp(value: Column, low: Column, high: Column) -> Column:
    """Null stays null; a null bound is none."""
    return F.when(value.isNotNull(), F.greatest(low, F.least(high, value)))


def struck_price(original: Column, final: Column, compare_at: Column) -> Column:
    """The price shown struck through: the original where it differs, else a higher compare-at price, else null."""
    return F.when(truly(original != final), original).when(truly(compare_at > original), compare_at)


def from_price(low: Column, high: Column, swatches_only: Column) -> Column:
    """The lowest price where prices vary and not only swatches do; else null."""
    return F.when(truly(high > low) & ~truly(swatches_only), low)


def price_bounds(breaks: Column, base: Column) -> tuple[Column, Column]:
    """With breaks, the last break's price and the base price; else the base twice."""
    return F.coalesce(F.try_element_at(breaks, F.lit(-1))["price"], base), base


def filled_stars(rating: Column) -> Column:
    """Whole stars, and one more where the fraction is at least 0.3."""
    fraction = rating - F.floor(rating)
    return F.floor(rating) + F.when(fraction >= F.lit("0.3").cast("decimal(3,2)"), 1).otherwise(0)


def star_fraction(rating: Column) -> Column:
    fraction = rating - F.floor(rating)
    return F.when(fraction > F.lit("0.7").cast("decimal(3,2)"), 1.0).when(fraction >= F.lit("0.3").cast("decimal(3,2)"), 0.5).otherwise(0.0)


def visible_properties(properties: Column) -> Column:
    """Entries with a value and a name that doesn't start with an underscore; uploads show their file name."""
    shown = F.map_filter(properties, lambda k, v: ~is_blank(v) & ~k.startswith("_"))
    return F.transform_values(shown, lambda _, v: F.when(v.contains("/uploads/"), F.element_at(F.split(v, "/"), -1)).otherwise(v))


def gift_card_ok(enabled: Column, expired: Column) -> Column:
    return truly(enabled) & ~truly(expired)


def sendable(day: Column, today: Column, days: int = 90) -> Column:
    return truly(day.between(today, F.date_add(today, days)))


def plural(count: Column, one: str, other: str, hole: str = "{{ count }}") -> Column:
    text = F.when(count == 1, one).otherwise(other)
    return F.replace(text, F.lit(hole), count.cast("string"))


def optimistic_count(current: Column, change: Column, from_form: Column) -> Column:
    """A product form adds to the count, any other source sets it."""
    return F.when(truly(from_form), current + change).otherwise(change)


def duties_text(duties_included: Column, taxes_included: Column, has_policy: Column, has_discounts: Column) -> Column:
    """Which of the tax notes applies, by name."""
    taxes = F.when(truly(duties_included) & truly(taxes_included), "duties_and_taxes_included").when(truly(taxes_included), "taxes_included").when(truly(duties_included), "duties_included").otherwise("taxes")
    discount = F.when(truly(has_discounts), "_discounts").otherwise("")
    return F.concat(taxes, discount, F.when(truly(has_policy), "_shipping_policy").otherwise("_shipping"))
