"""Carts: read from JSON documents, and kept as a table of lines that is changed in place, a part at a time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.sources.store import settings, stored

#: A cart as the storefront's API gives it; what else it holds is passed over.
CART = (
    "token string, note string, item_count int, total_price long, currency string,"
    " items array<struct<key: string, variant_id: long, product_id: long, quantity: int, price: long, original_line_price: long, title: string,"
    " properties: map<string, string>, item_components: array<struct<title: string, quantity: int>>>>"
)


def read_carts(spark: SparkSession, path: str) -> DataFrame:
    """CART's columns and ``corrupt``: a document a line; one that isn't JSON, or has a value of another type, is kept there whole."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "corrupt"}
    return spark.read.text(path).filter("trim(value) <> ''").select(F.from_json("value", f"{CART}, corrupt string", options).alias("cart")).select("cart.*")


def lines_of(carts: DataFrame) -> DataFrame:
    """token, line (from 1), and an item's columns, for carts that could be read; empty carts have none."""
    each = carts.filter("corrupt is null").select("token", F.posexplode("items").alias("line", "item"))
    return each.select("token", (F.col("line") + 1).alias("line"), "item.*")


def quality(carts: DataFrame) -> DataFrame:
    """carts, broken, mismatched: how many documents, how many that couldn't be read, how many whose count isn't that of their items."""
    counted = F.aggregate("items", F.lit(0), lambda total, x: total + F.coalesce(x["quantity"], F.lit(0)))
    ok = F.col("corrupt").isNull()
    return carts.agg(F.count("*").alias("carts"), F.count_if(~ok).alias("broken"), F.count_if(ok & (F.coalesce(counted, F.lit(0)) != F.coalesce("item_count", F.lit(0)))).alias("mismatched"))


def to_carts(lines: DataFrame, token: str, line: str) -> DataFrame:
    """The way back: token and json, an object for each cart with its items in order."""
    item = [c for c in lines.columns if c not in (token, line)]
    items = F.transform(F.array_sort(F.collect_list(F.struct(line, *item))), lambda x: F.struct(*(x[c].alias(c) for c in item)))
    carts = lines.groupBy(F.col(token).alias("token")).agg(items.alias("items"), F.sum("quantity").cast("int").alias("item_count"))
    return carts.select("token", F.to_json(F.struct("token", "item_count", "items")).alias("json"))


def bucket_of(cart: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(cart), F.lit(buckets)).cast("int")


class CartTable:
    """Lines (cart, variant, quantity) in partitions by a hash of the cart; a change rewrites those it has a part in, whole.

    Repeating a change changes nothing, so one that was cut off can be made again.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.schema = "cart_id long, variant_id long, quantity long"

    def create(self, lines: DataFrame) -> None:
        """Lines of one cart and variant are summed."""
        own = lines.groupBy(F.col("cart_id").cast("long"), F.col("variant_id").cast("long")).agg(F.sum("quantity").cast("long").alias("quantity"))
        self._write(own.filter("cart_id is not null and variant_id is not null and quantity <> 0"))

    def lines(self, of: Sequence[int] | None = None) -> DataFrame:
        rows = self.spark.read.schema(f"{self.schema}, bucket int").parquet(self.path)
        return (rows if of is None else rows.filter(F.col("bucket").isin(*of))).filter("cart_id is not null").drop("bucket")

    def _write(self, lines: DataFrame) -> None:
        marked = lines.withColumn("bucket", F.coalesce(F.expr("bucket") if "bucket" in lines.columns else F.lit(None), bucket_of("cart_id", self.buckets)))
        with settings(self.spark, spark__sql__sources__partitionOverwriteMode="dynamic"):
            marked.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(self.path)

    def set(self, changes: DataFrame) -> list[int]:
        """Sets quantities (cart_id, variant_id, quantity[, at]): 0 deletes; of several changes of a line the one with the largest
        (at, quantity) holds. The partitions that were rewritten."""
        at = F.col("at") if "at" in changes.columns else F.lit(0)
        last = changes.groupBy(F.col("cart_id").cast("long"), F.col("variant_id").cast("long")).agg(F.max_by("quantity", F.struct(at, "quantity")).cast("long").alias("wanted"))
        last = stored(last.filter("cart_id is not null and variant_id is not null").withColumn("bucket", bucket_of("cart_id", self.buckets)), "cart-changes")
        met = [r.bucket for r in last.select("bucket").distinct().collect()]  # at most ``buckets``
        joined = self.lines(met).join(last.drop("bucket"), ["cart_id", "variant_id"], "full")
        differs = F.coalesce("wanted", "quantity") != F.coalesce("quantity", F.lit(0))
        touched = sorted(r.bucket for r in joined.filter(differs).select(bucket_of("cart_id", self.buckets).alias("bucket")).distinct().collect())
        if touched:
            new = joined.select("cart_id", "variant_id", F.coalesce("wanted", "quantity").alias("quantity")).filter("quantity <> 0").withColumn("bucket", bucket_of("cart_id", self.buckets))
            # A partition whose lines are all gone is overwritten by a row without a cart.
            gone = self.spark.createDataFrame([(None, None, None, b) for b in touched], f"{self.schema}, bucket int")
            self._write(stored(new.filter(F.col("bucket").isin(*touched)).unionByName(gone), "cart-lines"))
        return touched

    def add(self, adds: DataFrame) -> list[int]:
        """Adds quantities to what is there; repeated by a caller it would add again, so it is a set of the sums."""
        more = adds.groupBy("cart_id", "variant_id").agg(F.sum("quantity").alias("more"))
        sums = more.join(self.lines(), ["cart_id", "variant_id"], "left").select("cart_id", "variant_id", (F.col("more") + F.coalesce("quantity", F.lit(0))).alias("quantity"))
        return self.set(sums)
