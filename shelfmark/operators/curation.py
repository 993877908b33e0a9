"""Curated lists: what is next, what was seen, what else there is."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def upcoming(events: DataFrame, day: Column, today: str, index: Column, count: int) -> DataFrame:
    """The next events from today on; of one day, by their index as text ('10' before '2')."""
    own = events.withColumn("day", F.date_format(day, "yyyy-MM-dd"))
    return own.filter(F.col("day") >= today).orderBy("day", index.cast("string")).limit(count)


def recently_viewed(views: DataFrame, user: str, item: str, when: Sequence[str], keep: int = 4) -> DataFrame:
    """user, item, place: each user's last distinct items, the latest first. ``when`` orders views totally."""
    last = views.groupBy(user, item).agg(F.max(F.struct(*when)).alias("_at"))
    return last.withColumn("place", F.row_number().over(Window.partitionBy(user).orderBy(F.desc("_at")))).filter(F.col("place") <= keep).drop("_at")


def recommendation_fallback(catalog: DataFrame, key: str, own: object, intent: str, count: int) -> DataFrame:
    """Without recommendations: related ones are the rest of the catalog, complementary ones none."""
    if intent != "related":
        return catalog.limit(0)
    return catalog.filter(F.col(key) != F.lit(own)).orderBy(key).limit(count)


def bought_together(lines: DataFrame, order: str, item: str, count: int, part: int = 128) -> DataFrame:
    """item, other, n, place: what is most often in the same order (our decision). Each pair is met once, summed before the
    shuffle, and then mirrored. The items of an order are cut into parts of about ``part``, each of which meets the whole order as
    a group of its own, so a long order is many tasks' work."""
    own = lines.select(order, item).distinct()
    sizes = own.groupBy(order).agg(F.ceil(F.count("*") / part).cast("int").alias("_parts"))
    dealt = own.join(sizes, order)
    left = dealt.withColumn("_part", F.pmod(F.xxhash64(item), F.col("_parts")).cast("int")).drop("_parts")
    right = dealt.select(order, F.col(item).alias("other"), F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_part"))
    pairs = left.join(right, [order, "_part"]).filter(F.col(item) < F.col("other"))
    once = pairs.groupBy(item, "other").agg(F.count("*").alias("n"))
    both = F.explode(F.array(F.struct(F.col(item).alias("a"), F.col("other").alias("b")), F.struct(F.col("other").alias("a"), F.col(item).alias("b"))))
    counted = once.select(both.alias("x"), "n").select(F.col("x.a").alias(item), F.col("x.b").alias("other"), "n")
    best = Window.partitionBy(item).orderBy(F.desc("n"), "other")
    return counted.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= count)


def nearest(values: Column, target: Column) -> Column:
    """The array's value with the smallest distance; of equal ones the earliest."""
    ranked = F.transform(values, lambda v, i: F.struct(F.abs(v - target).alias("d"), i.alias("i"), v.alias("v")))
    return F.array_min(ranked)["v"]


def waitlist_matches(returned: DataFrame, waiting: DataFrame, item: str) -> DataFrame:
    """Who waits for what has come back; returned can be a stream."""
    return returned.join(waiting, item)


def published(rows: DataFrame, at: str, now: Column) -> DataFrame:
    return rows.filter(F.col(at) <= now)


def members_with_birthday(members: DataFrame, today: Column) -> DataFrame:
    """Active members (a tag says so) born on this day."""
    return members.filter(F.array_contains("tags", "active-subscription") & (F.month("birthday") == F.month(today)) & (F.day("birthday") == F.day(today)))


def member_price(price: Column, tags: Column) -> Column:
    """Ten percent off, rounded to minor units, for subscribers who aren't renters only."""
    member = F.array_contains(tags, "active-subscription") & ~F.array_contains(tags, "renter")
    return F.when(F.coalesce(member, F.lit(False)), F.round(price.cast("decimal(20,0)") * 9 / 10, 0).cast("long")).otherwise(price)


def availability(copies: DataFrame, product: str) -> DataFrame:
    """product, copies, available: sold copies leave the pool."""
    return copies.groupBy(product).agg(F.count_if(F.col("status") != "Sold").alias("copies"), F.count_if(F.col("status") == "Available").alias("available"))


def curated(rows: DataFrame, refs: str, products: DataFrame, key: str) -> DataFrame:
    """Hand-picked references of each row, in their order; those without a product are left out."""
    each = rows.select(*(c for c in rows.columns if c != refs), F.posexplode(refs).alias("pos", key))
    return each.join(products, key)


def pickup_locations(places: DataFrame, enabled: str) -> DataFrame:
    """Those where orders can be picked up; an unknown is none."""
    return places.filter(F.coalesce(enabled, F.lit(False)))


def collection_cap(layout: Column, count: Column, setting: Column, columns: Column) -> Column:
    """How many collections a list shows: an explicit count, else the setting, else by its layout."""
    by_layout = F.when(layout == "carousel", columns + 2).when(layout == "grid", columns).otherwise(F.lit(4))
    return F.coalesce(count, setting, by_layout)


def capped(rows: DataFrame, group: str, order: Sequence[str], cap: Column) -> DataFrame:
    """The first rows of each group, as many as its cap says."""
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy(*order))).filter(F.col("place") <= cap)


def condition_prices(copies: DataFrame, prices: DataFrame, condition: str) -> DataFrame:
    """Copies that aren't sold, at the price of their condition. Conditions are few, so prices go to every task: by a shuffle, each
    condition's copies would be one task's work."""
    return copies.filter(F.col("status") != "Sold").join(F.broadcast(prices), condition)


def surplus_pool(copies: DataFrame, product: str, keep: int, order: str) -> DataFrame:
    """Copies beyond the first ``keep`` of each product."""
    return copies.withColumn("place", F.row_number().over(Window.partitionBy(product).orderBy(order))).filter(F.col("place") > keep)
