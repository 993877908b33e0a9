"""Tables with explicit schemas, JSON and key-value sources, and keyed writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Schemas of the tables that the catalog reads; nothing is inferred.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "labels": "doc_id long, quality int, toxic int",
    "pages": "page_id long, url string, html string",
    "conversations": "conv_id long, turn int, role string, text string",
}

#: The catalog's own entities.
VARIANT = "variant_id long, product_id long, price long, inventory_management string, inventory_quantity int, inventory_policy string, rule_min int, rule_increment int, rule_max int, price_breaks array<struct<minimum_quantity:int,price:long>>"
CART_LINE = "cart_id long, line int, variant_id long, quantity int, original_line_price long, key string, parent_key string"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    if name == "conversations":  # its turn is a long or an int, by the writer
        return spark.read.parquet(path)
    return spark.read.schema(SCHEMAS[name]).parquet(path)


def from_json(rows: DataFrame, column: str, schema: str) -> DataFrame:
    """Inline JSON: the column's objects as a struct of the same name; what isn't JSON becomes null."""
    return rows.withColumn(column, F.from_json(column, schema))


def to_json_rows(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The JSON sink: keys, and the whole row as a JSON object."""
    return rows.select(*keys, F.to_json(F.struct(*rows.columns)).alias("json"))


def minor_units(price: Column, decimals: int = 2) -> Column:
    """Money is whole minor units; doubles go through decimals, never through a product of doubles."""
    return (price.cast("decimal(18,2)") * F.lit(10**decimals)).cast("long")


def alive(entries: DataFrame, now_ms: int, ttl_ms: int = 10_000) -> DataFrame:
    """A session store's entries (.., timestamp in ms) that are younger than their time to live."""
    return entries.filter(F.lit(now_ms) - F.col("timestamp") < ttl_ms)


def upsert(lines: DataFrame, changes: DataFrame, keys: Sequence[str], quantity: str = "quantity", order: str | None = None) -> DataFrame:
    """lines after keyed changes (keys, quantity[, order]): the last change of a key wins by its order, of those without one
    or with the same the largest quantity; quantity 0 deletes."""
    changes = changes.select(*keys, quantity, (F.col(order) if order else F.lit(0)).alias("_order"))
    changes = changes.groupBy(*keys).agg(F.max(F.struct("_order", quantity)).alias("_last")).select(*keys, f"_last.{quantity}")
    new = changes.select(*keys, F.col(quantity).alias("_new"))
    merged = lines.join(new, list(keys), "full_outer").withColumn(quantity, F.coalesce("_new", quantity)).drop("_new")
    return merged.filter(F.col(quantity) != 0).select(*lines.columns)


def upsert_map(lines: DataFrame, updates: Column, key: str) -> DataFrame:
    """A bulk update {key: quantity} given as a map column."""
    changes = lines.sparkSession.range(1).select(F.explode(updates).alias(key, "quantity"))
    return upsert(lines, changes.withColumn(key, F.col(key).cast(lines.schema[key].dataType)), [key])
