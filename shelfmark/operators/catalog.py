"""Faceted filtering, counts, search, sorting and paging."""

from __future__ import annotations

import base64
import json
from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from shelfmark.functions.text import all_terms_match
from shelfmark.plans.request import CatalogRequest, Facets


def filtered(products: DataFrame, request: CatalogRequest, facets: Facets, leave_out: str | None = None) -> DataFrame:
    """Plain predicates, so they reach the scan; the price in whole units does too, by bounds a little wider."""
    price = F.lit(True)
    if leave_out != facets.price:
        price = request.price_condition(F.col(facets.price))
        if facets.raw_price:
            price = price & request.wide_condition(F.col(facets.raw_price))
    return products.filter(request.list_conditions(leave_out, facets.booleans) & price)


def facet_counts(products: DataFrame, request: CatalogRequest, facets: Facets) -> DataFrame:
    """facet, value, n, active, disabled: how many products each value would show, its own facet's choice left out
    (our decision). A value that nothing matches is kept with 0.

    One scan: each row carries which facets' conditions it fails, and is counted for a facet if it fails no other. Values
    are counted before the shuffle.
    """
    names = list(facets.lists)
    price = request.price_condition(F.col(facets.price))
    meets = {f: F.col(f).cast("string").isin(*request.filters[f]) if request.filters.get(f) else F.lit(True) for f in names}
    others = {f: reduce(Column.__and__, [meets[g] for g in names if g != f], price) for f in names}
    each = F.explode(F.array(*(F.struct(F.lit(f).alias("facet"), F.col(f).cast("string").alias("value"), others[f].alias("in")) for f in names)))
    counted = products.select(each.alias("x")).groupBy("x.facet", "x.value").agg(F.count_if("x.in").alias("n"))
    pairs = [F.struct(F.lit(f), F.lit(v)) for f, values in request.filters.items() for v in values]
    active = F.struct("facet", "value").isin(*pairs) if pairs else F.lit(False)
    return counted.select("facet", "value", "n", active.alias("active"), ((F.col("n") == 0) & ~active).alias("disabled"))


def active_value_count(filters: Column) -> Column:
    """Of an array of (type, low, high, active values): a price range counts once if it has a bound, a boolean once if its
    first active value is true, any other by its active values."""
    one = lambda f: (
        F.when(f["type"] == "price_range", (f["low"].isNotNull() | f["high"].isNotNull()).cast("int"))
        .when(f["type"] == "boolean", F.coalesce(F.get(f["values"], F.lit(0)) == "true", F.lit(False)).cast("int"))
        .otherwise(F.size(f["values"]))
    )
    return F.aggregate(filters, F.lit(0), lambda total, f: total + one(f))


def visible_values(counts: DataFrame, shown: int = 10, swatches: Sequence[str] = (), images: Sequence[str] = (), swatch_labels: bool = False) -> DataFrame:
    """Adds place and hidden: the first values of each facet stay visible, 22 swatches or 6 images; one more isn't worth
    hiding, and swatches without labels are all shown."""
    order, whole = Window.partitionBy("facet").orderBy(F.desc("n"), "value"), Window.partitionBy("facet")
    among = lambda names: F.col("facet").isin(*names) if names else F.lit(False)
    first = F.when(among(images), 6).when(among(swatches), 22).otherwise(shown)
    exempt = F.lit(False) if swatch_labels else among(swatches)
    placed = counts.withColumn("place", F.row_number().over(order)).withColumn("of", F.count("*").over(whole))
    return placed.withColumn("hidden", (F.col("of") > first + 1) & (F.col("place") > first) & ~exempt).drop("of")


def pill_layout(values: DataFrame, booleans: Sequence[str] = ()) -> DataFrame:
    """Facets all of whose labels have at most three characters are laid out as pills, but boolean ones."""
    short = F.bool_and(F.length("value") <= 3)
    return values.groupBy("facet").agg((short & ~F.col("facet").isin(*booleans) if booleans else short).alias("pills"))


def sort_columns(sort: str, facets: Facets) -> list[Column]:
    """A total order: the id breaks ties."""
    columns = {
        "manual": [],
        "title-ascending": [F.asc(facets.title)],
        "title-descending": [F.desc(facets.title)],
        "price-ascending": [F.asc(facets.price)],
        "price-descending": [F.desc(facets.price)],
    }
    return [*columns[sort], F.asc(facets.key)]


def page_of(rows: DataFrame, order: Sequence[Column], page: int, size: int) -> DataFrame:
    """One page; Spark keeps page * size rows of each task at most."""
    return rows.orderBy(*order).offset((page - 1) * size).limit(size)


def search_page(products: DataFrame, request: CatalogRequest, facets: Facets) -> DataFrame:
    """Filter, search, sort and cut the page: filters always before the page."""
    own = request.normalized()
    found = filtered(products, own, facets)
    if own.q:
        found = found.filter(all_terms_match(F.col(facets.title), own.q))
    return page_of(found, sort_columns(own.sort, facets), own.page, own.page_size)


def page_count(rows: DataFrame, size: int) -> DataFrame:
    """rows, pages: at least one page."""
    return rows.agg(F.count("*").alias("rows")).withColumn("pages", F.greatest(F.lit(1), F.ceil(F.col("rows") / size)).cast("long"))


def page_links(page: int, pages: int) -> list[int | None]:
    """First, last and the page's neighbours; None where some are left out."""
    shown = sorted({1, pages, *(p for p in range(page - 1, page + 2) if 1 <= p <= pages)})
    out: list[int | None] = []
    for p in shown:
        if out and p - (out[-1] or 0) > 1:
            out.append(None)
        out.append(p)
    return out


def page_links_of(page: Column, pages: Column) -> Column:
    """The same for columns: an array in which null stands where some are left out."""
    near = F.filter(F.array(F.lit(1), page - 1, page, page + 1, pages), lambda p: (p == 1) | (p == pages) | ((p > 0) & (p < pages)))
    shown = F.array_sort(F.array_distinct(F.transform(near, lambda p: p.cast("int"))))
    gap = lambda p, i: (i > 0) & (p - F.get(shown, i - 1) > 1)
    return F.flatten(F.transform(shown, lambda p, i: F.when(gap(p, i), F.array(F.lit(None).cast("int"), p)).otherwise(F.array(p))))


def _beyond(rows: DataFrame, order: Sequence[tuple[str, bool]], values: Sequence[object], forward: bool) -> Column:
    """Rows after (or before) the row with these values, as plain comparisons, so that the first column's bound reaches the scan."""
    out = F.lit(False)
    for (name, ascending), x in reversed(list(zip(order, values, strict=True))):
        column, value = F.col(name), F.lit(x).cast(rows.schema[name].dataType)
        further, not_back = (column > value, column >= value) if ascending == forward else (column < value, column <= value)
        out = further if name == order[-1][0] else not_back & (further | out)
    return out


def keyset_page(rows: DataFrame, order: Sequence[str], after: Sequence[object] | None, size: int) -> DataFrame:
    """The page after a row: nothing before it is sorted, which deep pages need."""
    if after is not None:
        rows = rows.filter(_beyond(rows, [(c, True) for c in order], after, True))
    return rows.orderBy(*order).limit(size)


@dataclass(frozen=True)
class Cursor:
    """Where a page begins: beyond the row with these values of the order's columns, onwards or back, for one request."""

    request: str
    values: tuple
    forward: bool = True

    def text(self) -> str:
        return base64.urlsafe_b64encode(json.dumps([self.request, list(self.values), self.forward]).encode()).decode()

    @staticmethod
    def of(text: str) -> Cursor:
        request, values, forward = json.loads(base64.urlsafe_b64decode(text))
        return Cursor(request, tuple(values), forward)


def order_of(sort: str | None, facets: Facets) -> list[tuple[str, bool]]:
    """The columns of a sort, each ascending or not; the id breaks ties."""
    name, _, direction = (sort or "manual").partition("-")
    return [*([(facets.title if name == "title" else facets.price, direction == "ascending")] if direction else []), (facets.key, True)]


def cursor_page(products: DataFrame, request: CatalogRequest, facets: Facets, cursor: Cursor | None = None) -> DataFrame:
    """The page that a cursor leads to, in the request's order; the first page without one.

    Backwards the order is reversed, cut, and put right again. A cursor of a request with other filters, search or sort is refused.
    """
    own = request.normalized()
    rows, order = filtered(products, own, facets), order_of(own.sort, facets)
    if own.q:
        rows = rows.filter(all_terms_match(F.col(facets.title), own.q))
    sorted_by = lambda forward: [F.asc(c) if ascending == forward else F.desc(c) for c, ascending in order]
    if cursor is None:
        return rows.orderBy(*sorted_by(True)).limit(own.page_size)
    if cursor.request != replace(own, page=1).key():
        raise ValueError("the cursor belongs to another request")
    page = rows.filter(_beyond(rows, order, cursor.values, cursor.forward)).orderBy(*sorted_by(cursor.forward)).limit(own.page_size)
    return page if cursor.forward else page.orderBy(*sorted_by(True))


def cursors(page: Sequence[Row], request: CatalogRequest, facets: Facets) -> tuple[Cursor, Cursor] | None:
    """Those of the pages before and after a page that was read; null for an empty one."""
    own = request.normalized()
    key, columns = replace(own, page=1).key(), [c for c, _ in order_of(own.sort, facets)]
    return (Cursor(key, tuple(page[0][c] for c in columns), False), Cursor(key, tuple(page[-1][c] for c in columns))) if page else None


def predictive(resources: dict[str, tuple[DataFrame, str, str]], query: str, each: int) -> DataFrame:
    """object_type, id, title: the first matches of each resource, by title and id. resources: rows, id and title columns."""
    parts = []
    for kind, (rows, key, title) in resources.items():
        found = rows.filter(all_terms_match(F.col(title), query.strip())) if query.strip() else rows.limit(0)
        best = found.select(F.lit(kind).alias("object_type"), F.col(key).cast("long").alias("id"), F.col(title).alias("title")).orderBy("title", "id").limit(each)
        parts.append(best)
    return reduce(DataFrame.unionByName, parts)


def resource_totals(resources: dict[str, tuple[DataFrame, str, str]], query: str) -> DataFrame:
    """object_type, n of each resource."""
    parts = [rows.filter(all_terms_match(F.col(title), query)).agg(F.count("*").alias("n")).select(F.lit(kind).alias("object_type"), "n") for kind, (rows, _, title) in resources.items()]
    return reduce(DataFrame.unionByName, parts)


def or_fallback(found: DataFrame, fallback: DataFrame) -> DataFrame:
    """What was found, or the fallback if that is nothing: one row is looked at, when the result is computed."""
    any_row = found.limit(1).select(F.lit(1).alias("_any"))
    return found.unionByName(fallback.withColumn("_any", F.lit(1)).join(F.broadcast(any_row), "_any", "left_anti").drop("_any"))


def one_total(totals: DataFrame) -> DataFrame:
    """n: the sum over all kinds."""
    return totals.agg(F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("n"))


def single_result(resources: dict[str, tuple[DataFrame, str, str]], query: str, precedence: Sequence[str]) -> DataFrame:
    """object_type, id, title of the first kind, by precedence, that has exactly one match: two of each are looked at."""
    hits = []
    for place, kind in enumerate(precedence):
        rows, key, title = resources[kind]
        found = rows.filter(all_terms_match(F.col(title), query)).select(F.lit(place).alias("_place"), F.lit(kind).alias("object_type"), F.col(key).cast("long").alias("id"), F.col(title).alias("title"))
        hits.append(only_hit(found))
    return reduce(DataFrame.unionByName, hits).orderBy("_place").limit(1).drop("_place")


def valid_page(page: Column, rows: Column, size: int) -> Column:
    """From the first to the last page; without rows there is one."""
    return (page >= 1) & (page <= F.greatest(F.lit(1), F.ceil(rows / size)))


def only_hit(found: DataFrame) -> DataFrame:
    """The row, if there is exactly one: two are looked at."""
    return found.limit(2).withColumn("_n", F.count("*").over(Window.partitionBy(F.lit(1)))).filter("_n = 1").drop("_n")


def mixed_page(tagged: DataFrame, order: Sequence[Column], page: int, size: int, kind: str) -> DataFrame:
    """A page of mixed results of which only one kind is shown afterwards, so it can be short. Only for compatibility:
    everything else here filters first."""
    return page_of(tagged, order, page, size).filter(F.col("object_type") == kind)
