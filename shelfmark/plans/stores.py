"""Registered queries that build a stored index or table from the given tables, and then read it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions import paths
from shelfmark.operators import bitmaps, catalog, search_index
from shelfmark.plans.queries import FACETS, REQUEST, cart_lines, products, read, resources
from shelfmark.plans.registry import ORACLES, query
from shelfmark.sources import carts
from shelfmark.sources.store import shared_folder


@query(ORACLES["search_text"])
def search_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of search_text, found in an inverted index."""
    docs, path = read(spark, sf_dir, "documents"), shared_folder(spark, "terms")
    search_index.build(docs, "doc_id", "text", path)
    return docs.select("doc_id", "lang").join(search_index.search(spark, path, "the ean").withColumnRenamed("id", "doc_id"), "doc_id", "left_semi")


@query(ORACLES["predictive_search"])
def predictive_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of predictive_search, found in a table of the best titles for each beginning of a word."""
    path, found = shared_folder(spark, "beginnings"), resources(spark, sf_dir)
    search_index.build_beginnings(found, path, longest=3, most=4)
    return search_index.suggested(spark, path, " s ", list(found), 4, longest=3)


@query(ORACLES["facet_counts"])
def facet_counts_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of facet_counts, from bitmaps."""
    path = shared_folder(spark, "facets")
    bitmaps.build(products(spark, sf_dir).withColumn("p_partkey", F.col("p_partkey") + 1), FACETS, path, band=1500)
    return bitmaps.facet_counts(spark, path, 1500, REQUEST, FACETS)


_DOC = """d AS (SELECT event_id, user_id, event_type, value, props, ('{"user":{"id":' || user_id || ',"tags":["all","' || event_type || '"],"none":null},"props":' || props || ',"place":' || event_id % 3 || '}')::JSON AS j FROM events)"""


@query(f"""WITH {_DOC} SELECT event_id, j->'props'->>'k' AS k, j->'user'->'tags'->>1 AS tag, CASE event_id % 3 WHEN 0 THEN 'all' WHEN 1 THEN event_type END AS chosen,
  NULL::VARCHAR AS beyond, NULL::VARCHAR AS missing, NULL::VARCHAR AS mismatch, event_type = 'view' AS is_view, (j->'props'->>'k')::INT <> 69 AS other_k, true AS no_name, false AS null_is_missing, event_id % 3 <> 0 AS placed FROM d""")
def path_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths into JSON documents made of events."""
    source = F.concat(
        F.lit('{"user":{"id":'), F.col("user_id"), F.lit(',"tags":["all","'), F.col("event_type"), F.lit('"],"none":null},"props":'), F.col("props"), F.lit(',"place":'), F.col("event_id") % 3, F.lit("}")
    )
    rows = read(spark, sf_dir, "events").select("event_id", paths.parsed(source).alias("doc"))
    of = lambda path: paths.at(F.col("doc"), path)
    shown = {"k": "props.k", "tag": "user['tags'][1]", "chosen": "user.tags[place]", "beyond": "user.tags[7]", "missing": "user.name.first", "mismatch": "user.id.tags[0]"}
    tests = {
        "is_view": paths.same(of("user.tags[1]"), paths.literal("view")),
        "other_k": ~paths.same(of("props.k"), paths.literal("69")),  # loosely, a text that stands for the number
        "no_name": paths.same(of("user.name"), paths.literal(None)),
        "null_is_missing": paths.identical(of("user.name"), of("user.none")),
        "placed": paths.truthy(of("place")),
    }
    return rows.select("event_id", *(paths.text(of(p)).alias(c) for c, p in shown.items()), *(t.alias(c) for c, t in tests.items()))


_CARTS = """l AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity::INT) AS line, l_partkey AS variant_id, l_quantity::INT AS quantity FROM lineitem)"""


def carts_as_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as carts, a JSON document a line; those of status P are cut off, so they can't be read."""
    lines = read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("token"), F.struct("l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("int").alias("q")).alias("line"),
        F.col("l_partkey").alias("variant_id"), F.col("l_quantity").cast("int").alias("quantity"),
    )
    status = read(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("token"), "o_orderstatus")
    whole = carts.to_carts(lines, "token", "line").join(status, "token")
    return whole.select(F.when(F.col("o_orderstatus") == "P", F.substring("json", 1, 40)).otherwise(F.col("json")).alias("value"))


@query(f"WITH {_CARTS} SELECT l_orderkey::VARCHAR AS token, line::INT AS line, variant_id, quantity FROM l JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'P'")
def cart_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Carts written as JSON and read again; those that were cut off give no lines."""
    path = shared_folder(spark, "carts")
    carts_as_json(spark, sf_dir).write.text(path)
    return carts.lines_of(carts.read_carts(spark, path)).select("token", "line", "variant_id", "quantity")


@query("SELECT count(*) AS carts, count_if(o_orderstatus = 'P') AS broken, 0::BIGINT AS mismatched FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)")
def cart_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that can't be read are counted, not lost."""
    path = shared_folder(spark, "carts")
    carts_as_json(spark, sf_dir).write.text(path)
    return carts.quality(carts.read_carts(spark, path))


@query("""WITH own AS (SELECT l_orderkey AS cart_id, l_partkey AS variant_id, sum(l_quantity::INT) AS q FROM lineitem GROUP BY ALL),
c AS (SELECT o_orderkey AS cart_id, o_orderkey % 50 + 1 AS variant_id, max(o_orderkey % 4) AS q FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL),
m AS (SELECT coalesce(own.cart_id, c.cart_id) AS cart_id, coalesce(own.variant_id, c.variant_id) AS variant_id, coalesce(c.q, own.q)::BIGINT AS quantity FROM own FULL JOIN c USING (cart_id, variant_id))
SELECT * FROM m WHERE quantity <> 0""")
def cart_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All carts as a stored table, changed in place; the change is made twice, which changes nothing more."""
    held = carts.CartTable(spark, shared_folder(spark, "cart-table"), buckets=16)
    held.create(cart_lines(spark, sf_dir))
    changes = read(spark, sf_dir, "orders").filter("o_orderstatus = 'F'")
    changes = changes.select(F.col("o_orderkey").alias("cart_id"), (F.col("o_orderkey") % 50 + 1).alias("variant_id"), (F.col("o_orderkey") % 4).alias("quantity"))
    held.set(changes)
    held.set(changes)
    return held.lines()
