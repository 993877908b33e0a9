"""Lookups by id: in order, by foreign key, semi and anti, parents and children."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ordered_lookup(rows: DataFrame, key: str, ids: Sequence[object]) -> DataFrame:
    """pos and the row of each id, in the ids' order; an id that isn't a number or isn't there has nulls."""
    asked = rows.sparkSession.createDataFrame([(i, None if x is None else str(x)) for i, x in enumerate(ids)], "pos int, asked string")
    wanted = asked.select("pos", F.expr("try_cast(asked as long)").alias("_key"))
    return wanted.join(rows, F.col("_key") == F.col(key), "left").drop("_key")


def pick_existing(picks: DataFrame, products: DataFrame, key: str, order: Sequence[str | Column], count: int) -> DataFrame:
    """The first picks whose product exists: the limit counts what survives the join."""
    return picks.join(products, key).orderBy(*order).limit(count)


def quantities(variants: DataFrame, lines: DataFrame, key: str, quantity: str, first: Sequence[str]) -> DataFrame:
    """Each variant with its summed quantity in the cart (0 without a line) and its first line, in the order of ``first``."""
    summed = lines.groupBy(key).agg(F.sum(quantity).alias("in_cart"), F.min(F.struct(*first)).alias("first_line"))
    return variants.join(summed, key, "left").withColumn("in_cart", F.coalesce("in_cart", F.lit(0)))


def without(rows: DataFrame, others: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.join(others.select(*keys), list(keys), "left_anti")


def within(rows: DataFrame, others: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.join(others.select(*keys), list(keys), "left_semi")


def cascade(lines: DataFrame, removed: DataFrame, key: str, parent: str) -> DataFrame:
    """The removed lines and their children, one level down; both by semi-joins."""
    gone = removed.select(F.col(key).alias("_gone"))
    both = F.col(key).eqNullSafe(F.col("_gone"))
    own = lines.join(gone, F.col(key) == F.col("_gone"), "left_semi")
    children = lines.join(gone, both, "left_anti").join(gone, F.col(parent) == F.col("_gone"), "left_semi")
    return own.unionByName(children)


def front_first(rows: DataFrame, group: Sequence[str], selected: Column, pos: str) -> DataFrame:
    """Adds place: the selected row of each group first, the others in their order."""
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(*group).orderBy(F.when(selected, 0).otherwise(1), pos)))


def numbered(rows: DataFrame, key: str, order: str, width: int) -> DataFrame:
    """Adds _i: the row's number within its key, from 1, by an order column of distinct whole numbers.

    Rows are numbered within stretches of ``width`` of the order column and get the counts of the stretches before, so a
    key with very many rows is no single task's work.
    """
    parted = rows.withColumn("_part", F.floor(F.col(order) / width))
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = parted.groupBy(key, "_part").count().withColumn("_before", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    local = parted.withColumn("_i", F.row_number().over(Window.partitionBy(key, "_part").orderBy(order)))
    return local.join(counts, [key, "_part"]).withColumn("_i", F.col("_i") + F.col("_before")).drop("_part", "_before")


def zip_by_key(left: DataFrame, right: DataFrame, key: str, left_order: str, right_order: str, width: int = 1 << 20) -> DataFrame:
    """Rows of equal key are paired in order, the i-th with the i-th."""
    return numbered(left, key, left_order, width).join(numbered(right, key, right_order, width), [key, "_i"]).drop("_i")


def media_kept(media: DataFrame, group: Sequence[str], pos: str, hidden: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Media that stay: those that aren't hidden, and the first of each group, as one is hidden only once another was kept."""
    first = media.groupBy(*group).agg(F.min(pos).alias("_first"))
    marked = media.join(first, list(group)).join(hidden.select(*keys).distinct().withColumn("_hidden", F.lit(True)), list(keys), "left")
    return marked.filter(F.col("_hidden").isNull() | (F.col(pos) == F.col("_first"))).drop("_first", "_hidden")


def by_index(text: Column, separator: str, values: Column) -> Column:
    """The array's value at the index that stands after the last separator of a key; null beyond its ends."""
    return F.get(values, F.element_at(F.split(text, separator), -1).try_cast("int"))


def in_collection(bridge: DataFrame, products: DataFrame, key: str, pos: str) -> DataFrame:
    """A collection's products by their position in it; ids break ties."""
    return bridge.join(products, key).orderBy(pos, key)


def split_by(rows: DataFrame, kind: str, kinds: Sequence[str]) -> dict[str, DataFrame]:
    """One list as several, by type."""
    return {k: rows.filter(F.col(kind) == k) for k in kinds}


def first_seen(rows: DataFrame, value: str, order: Sequence[str]) -> DataFrame:
    """Each value once, in the order in which they come up first: a minimum, taken before the shuffle."""
    return rows.groupBy(value).agg(F.min(F.struct(*order)).alias("_at")).orderBy("_at").select(value)


def first_with(rows: DataFrame, group: Sequence[str], order: Sequence[str], condition: Column) -> DataFrame:
    """The first row of each group that meets the condition: a minimum, taken before the shuffle."""
    rest = [c for c in rows.columns if c not in (*group, *order)]
    best = rows.filter(condition).groupBy(*group).agg(F.min(F.struct(*order, *rest)).alias("_x"))
    return best.select(*group, "_x.*")


def set_equal(a: Column, b: Column) -> Column:
    return (F.size(a) == F.size(b)) & (F.size(F.array_except(a, b)) == 0)


def add_if_absent(values: Column, value: Column) -> Column:
    return F.when(F.array_contains(values, value), values).otherwise(F.array_append(values, value))


def remove_first(values: Column, value: Column) -> Column:
    """Without the value's first occurrence."""
    at = F.array_position(values, value).cast("int")
    return F.when(at > 0, F.concat(F.slice(values, F.lit(1), at - 1), F.slice(values, at + 1, F.size(values)))).otherwise(values)


def resolve_variants(variants: DataFrame, selections: DataFrame, options: str) -> DataFrame:
    """Selections with the variant that has the same option values, in whatever order; null where none has."""
    keyed = lambda rows: rows.withColumn("_options", F.array_sort(options)).drop(options)
    return keyed(selections).join(keyed(variants), "_options", "left").drop("_options")
