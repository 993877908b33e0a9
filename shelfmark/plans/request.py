"""What a catalog page is asked for, checked and in a canonical form."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.functions.money import format_money

PAGE_SIZE = 24
SORTS = ("manual", "title-ascending", "title-descending", "price-ascending", "price-descending")


@dataclass(frozen=True)
class Facets:
    """Which columns are list facets, and which ones price, title and id are."""

    lists: tuple[str, ...]
    price: str
    title: str
    key: str
    raw_price: str | None = None
    #: Those of the lists that are boolean columns; their values are 'true' and 'false'.
    booleans: tuple[str, ...] = ()


@dataclass(frozen=True)
class CatalogRequest:
    """Filters are (facet, values); bounds are minor units, each optional and inclusive."""

    filters: dict[str, tuple[str, ...]] = field(default_factory=dict)
    price_gte: int | None = None
    price_lte: int | None = None
    q: str = ""
    sort: str | None = None
    page: int = 1
    page_size: int = PAGE_SIZE

    def normalized(self, range_max: int | None = None) -> CatalogRequest:
        """Empty filters go, values are in order, bounds are clamped to 0 and range_max, the query is trimmed; an unknown
        sort becomes the default, a page before the first the first."""
        bound = lambda x: x if x is None else max(0, x if range_max is None else min(range_max, x))
        return replace(
            self,
            filters={k: tuple(sorted(set(v))) for k, v in sorted(self.filters.items()) if v},
            price_gte=bound(self.price_gte),
            price_lte=bound(self.price_lte),
            q=self.q.strip(),
            sort=self.sort if self.sort in SORTS else SORTS[0],
            page=max(1, self.page),
        )

    def with_filters(self, **filters: tuple[str, ...]) -> CatalogRequest:
        """Changed filters start at the first page again."""
        return replace(self, filters={**self.filters, **filters}, page=1)

    def toggled(self, facet: str, value: str) -> CatalogRequest:
        """With the value added, or taken away if it was there."""
        held = self.filters.get(facet, ())
        return self.with_filters(**{facet: tuple(x for x in held if x != value) if value in held else (*held, value)})

    def cleared(self) -> CatalogRequest:
        return CatalogRequest(q=self.q, sort=self.sort, page_size=self.page_size)

    @property
    def is_filtered(self) -> bool:
        return any(self.filters.values()) or self.price_gte is not None or self.price_lte is not None

    def key(self) -> str:
        """Equal for requests that ask for the same."""
        own = self.normalized()
        pairs = [(f"filter.{k}", x) for k, v in own.filters.items() for x in v]
        pairs += [(k, str(x)) for k, x in (("price.gte", own.price_gte), ("price.lte", own.price_lte), ("q", own.q or None), ("sort", own.sort), ("page", own.page)) if x is not None]
        return "&".join(f"{k}={x}" for k, x in sorted(pairs))

    def list_conditions(self, leave_out: str | None = None, booleans: tuple[str, ...] = ()) -> Column:
        """Any value within a facet, all facets together (our decision). Boolean columns are compared as such, so that the
        scan can pass rows over."""
        out = F.lit(True)
        for name, values in self.filters.items():
            if values and name != leave_out:
                of = F.col(name).cast("string").isin(*values)
                if name in booleans:
                    of = reduce(Column.__or__, [F.col(name) == (v == "true") for v in sorted(set(values) & {"true", "false"})] or [F.lit(False)])
                out = out & of
        return out

    def price_condition(self, price: Column) -> Column:
        out = F.lit(True)
        if self.price_gte is not None:
            out = out & (price >= self.price_gte)
        if self.price_lte is not None:
            out = out & (price <= self.price_lte)
        return out

    def wide_condition(self, price: Column, minor: int = 100) -> Column:
        """What the bounds imply for a price in whole units that is stored as a double."""
        out = F.lit(True)
        if self.price_gte is not None:
            out = out & (price >= (self.price_gte - 1) / minor)
        if self.price_lte is not None:
            out = out & (price <= (self.price_lte + 1) / minor)
        return out


def range_summary(low: Column, high: Column, range_max: Column) -> tuple[Column, Column]:
    """The bounds to show: a missing minimum is 0, a missing maximum the range's."""
    return F.coalesce(low, F.lit(0).cast("long")), F.coalesce(high, range_max)


def range_text(low: Column, high: Column, range_max: Column, template: str, currency: Column) -> Column:
    """Both bounds as money with a dash between; empty where neither was typed."""
    first, last = range_summary(low, high, range_max)
    return F.when(low.isNull() & high.isNull(), "").otherwise(F.concat(format_money(first, template, currency), F.lit("–"), format_money(last, template, currency)))


def clamp_bounds(low: Column, high: Column, range_max: Column) -> tuple[Column, Column]:
    """Each bound within [0, range_max] and on its own side of the other; an empty one stays empty."""
    return F.when(low.isNotNull(), F.greatest(F.lit(0).cast("long"), F.least(low, F.coalesce(high, range_max)))), F.when(
        high.isNotNull(), F.greatest(F.coalesce(low, F.lit(0).cast("long")), F.least(high, range_max))
    )
