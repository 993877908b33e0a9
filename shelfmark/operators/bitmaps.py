"""A stored facet index: a bitmap of ids for each facet value, so that counts under any choice come from bitmaps alone.

Ids are cut into buckets of 32,768, one bitmap of 4 KB each, so an index has a row for each value and bucket that it occurs in,
and all work on it is by bucket. Prices are bitmaps of bands; a bound within a band is settled by that band's rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.plans.request import CatalogRequest, Facets

BANDS, ROWS = "price bands", "price rows"


def _set(rows: DataFrame, *keys: str) -> DataFrame:
    """A bitmap of the ids of each key and bucket."""
    located = rows.withColumns({"bucket": F.bitmap_bucket_number("id"), "bit": F.bitmap_bit_position("id")})
    return located.groupBy(*keys, "bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))


def build(products: DataFrame, facets: Facets, path: str, band: int) -> None:
    """Writes values (facet, value, bucket, bits; by facet) and price rows (band, id, price; by band). Ids are positive."""
    each = F.explode(F.array(*(F.struct(F.lit(f).alias("facet"), F.col(f).cast("string").alias("value")) for f in facets.lists)))
    rows = products.select(F.col(facets.key).cast("long").alias("id"), F.col(facets.price).cast("long").alias("price"), *facets.lists)
    values = _set(rows.select("id", each.alias("x")).select("id", "x.*"), "facet", "value")
    prices = rows.select("id", "price", F.floor(F.col("price") / band).cast("long").alias("band"))
    bands = _set(prices, "band").select(F.lit(BANDS).alias("facet"), F.col("band").cast("string").alias("value"), "bucket", "bits")
    values.unionByName(bands).repartition("facet").sortWithinPartitions("value", "bucket").write.partitionBy("facet").parquet(f"{path}/values")
    prices.repartitionByRange("band").sortWithinPartitions("band", "id").write.parquet(f"{path}/prices")


def _chosen(spark: SparkSession, path: str, band: int, request: CatalogRequest, facets: Facets) -> dict[str, DataFrame]:
    """For each facet with a choice (and the price, under its own name) the ids that meet it: bucket, bits."""
    values = spark.read.schema("value string, bucket long, bits binary, facet string").parquet(f"{path}/values")
    either = lambda rows: rows.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    out = {f: either(values.filter((F.col("facet") == f) & F.col("value").isin(*request.filters[f]))) for f in facets.lists if request.filters.get(f)}
    low, high = request.price_gte, request.price_lte
    if low is not None or high is not None:
        first = None if low is None else -(-low // band)  # the bands that lie within the bounds as a whole
        last = None if high is None else (high + 1) // band - 1
        number = F.col("value").cast("long")
        inside = reduce(Column.__and__, [*([number >= first] if first is not None else []), *([number <= last] if last is not None else [])])
        whole = values.filter((F.col("facet") == BANDS) & inside).select("bucket", "bits")
        edges = sorted({x // band for x in (low, high) if x is not None})
        rows = spark.read.schema("id long, price long, band long").parquet(f"{path}/prices").filter(F.col("band").isin(*edges))
        out[facets.price] = either(whole.unionByName(_set(rows.filter(request.price_condition(F.col("price"))).select("id")).select("bucket", "bits")))
    return out


def facet_counts(spark: SparkSession, path: str, band: int, request: CatalogRequest, facets: Facets) -> DataFrame:
    """facet, value, n, active, disabled, as the counts from rows are: a facet's own choice is left out of its counts.

    A value's bitmap meets those of the other facets' choices, bucket by bucket; the chosen sets have a row for each bucket.
    """
    values = spark.read.schema("value string, bucket long, bits binary, facet string").parquet(f"{path}/values")
    chosen = _chosen(spark, path, band, request, facets)
    parts = []
    for facet in facets.lists:
        own = values.filter(F.col("facet") == facet).select("value", "bucket", "bits")
        others = [rows for f, rows in chosen.items() if f != facet]
        if not others:
            counted = own.groupBy("value").agg(F.sum(F.bitmap_count("bits")).alias("n"))
        else:
            both = reduce(DataFrame.unionByName, others).groupBy("bucket").agg(F.bitmap_and_agg("bits").alias("other"), F.count("*").alias("met"))
            both = both.filter(F.col("met") == len(others)).drop("met")  # a set without a row in a bucket has nothing there
            pairs = own.join(both, "bucket", "left")
            met = pairs.select("value", "bucket", F.explode(F.array("bits", "other")).alias("bits"), F.col("other").isNotNull().alias("any"))
            each = met.groupBy("value", "bucket").agg(F.bitmap_and_agg("bits").alias("bits"), F.bool_and("any").alias("any"))
            counted = each.groupBy("value").agg(F.sum(F.when(F.col("any"), F.bitmap_count("bits")).otherwise(0)).alias("n"))
        active = F.coalesce(F.col("value").isin(*request.filters.get(facet, ())), F.lit(False)) if request.filters.get(facet) else F.lit(False)
        parts.append(counted.select(F.lit(facet).alias("facet"), "value", "n", active.alias("active"), ((F.col("n") == 0) & ~active).alias("disabled")))
    return reduce(DataFrame.unionByName, parts)
