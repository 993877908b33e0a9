"""The catalog's registered queries, each with the DuckDB SQL that gives the same rows.

The tables don't resemble a storefront; the bindings are ours. Columns that a table lacks are derived from others by fixed
rules, in the query and in the SQL alike, and are synthetic.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.functions import arrays, money, rules, template, text
from shelfmark.operators import cart, catalog, curation, lookups
from shelfmark.plans.registry import ORACLES, QUERIES, query  # noqa: F401  the driver takes both from here
from shelfmark.plans.request import CatalogRequest, Facets, clamp_bounds, range_text
from shelfmark.sources.store import stored_in
from shelfmark.sources.tables import alive, from_json, minor_units, read, to_json_rows, upsert, upsert_map
from shelfmark.streaming import folds

FACETS = Facets(lists=("p_brand", "p_type", "p_size"), price="price", title="p_name", key="p_partkey", raw_price="p_retailprice")
REQUEST = CatalogRequest(filters={"p_brand": ("Brand#1", "Brand#12", "Brand#23"), "p_type": ("ECONOMY", "PROMO")}, price_gte=91_000, price_lte=98_000)
PRODUCT = "product AS (SELECT *, CAST(CAST(p_retailprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS price FROM part)"
LISTS = "p_brand IN ('Brand#1', 'Brand#12', 'Brand#23') AND p_type IN ('ECONOMY', 'PROMO')"
#: (minimum quantity, percent of the base price) of the synthetic price breaks.
BREAKS = ((10, 95), (25, 90), (40, 80))
#: A day within the events' span; nothing here reads a clock.
TODAY = "2024-01-15"
#: Rows of the input for each task of a shuffle whose tasks hold much.
ROWS_A_TASK = 500_000


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").withColumn("price", minor_units(F.col("p_retailprice")))


def whole(column: str) -> Column:
    return F.col(column).cast("long")


# Facets, sorting, paging


@query(f"WITH {PRODUCT} SELECT p_partkey, p_brand, p_type, price FROM product WHERE {LISTS}")
def facet_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = CatalogRequest(filters=REQUEST.filters)
    return catalog.filtered(products(spark, sf_dir), own, FACETS).select("p_partkey", "p_brand", "p_type", "price")


@query(f"WITH {PRODUCT} SELECT p_partkey, price FROM product WHERE price BETWEEN 91000 AND 98000")
def price_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = CatalogRequest(price_gte=REQUEST.price_gte, price_lte=REQUEST.price_lte)
    return catalog.filtered(products(spark, sf_dir), own, FACETS).select("p_partkey", "price")


@query(f"WITH {PRODUCT} SELECT p_partkey, p_name, price FROM product ORDER BY price DESC, p_partkey")
def sort_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products(spark, sf_dir).select("p_partkey", "p_name", "price").orderBy(*catalog.sort_columns("price-descending", FACETS))


@query(f"WITH {PRODUCT} SELECT p_partkey, p_name, price FROM product WHERE price BETWEEN 91000 AND 98000 ORDER BY p_name, p_partkey LIMIT 24 OFFSET 24")
def paginate(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = CatalogRequest(price_gte=REQUEST.price_gte, price_lte=REQUEST.price_lte, sort="title-ascending", page=2)
    return catalog.search_page(products(spark, sf_dir), own, FACETS).select("p_partkey", "p_name", "price")


@query("SELECT count(*) AS rows, greatest(1, ceil(count(*) / 24))::BIGINT AS pages FROM part")
def page_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.page_count(products(spark, sf_dir), 24)


@query("SELECT p_partkey, p_name FROM part WHERE (p_name, p_partkey) > ('red', 100) ORDER BY p_name, p_partkey LIMIT 24")
def keyset_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = products(spark, sf_dir).select("p_partkey", "p_name")
    return catalog.keyset_page(rows, ("p_name", "p_partkey"), ("red", 100), 24)


_COUNTS = f"""WITH {PRODUCT}, ok AS (SELECT *, p_brand IN ('Brand#1', 'Brand#12', 'Brand#23') AS b, p_type IN ('ECONOMY', 'PROMO') AS t,
  price BETWEEN 91000 AND 98000 AS p FROM product),
one AS (SELECT 'p_brand' AS facet, p_brand AS value, t AND p AS inside, b AS active FROM ok
  UNION ALL SELECT 'p_type', p_type, b AND p, t FROM ok
  UNION ALL SELECT 'p_size', p_size::VARCHAR, b AND t AND p, false FROM ok),
counts AS (SELECT facet, value, count_if(inside)::BIGINT AS n, any_value(active) AS active, count_if(inside) = 0 AND NOT any_value(active) AS disabled
  FROM one GROUP BY facet, value)"""


@query(f"{_COUNTS} SELECT * FROM counts")
def facet_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.facet_counts(products(spark, sf_dir), REQUEST, FACETS)


@query(f"""{_COUNTS}, placed AS (SELECT *, row_number() OVER (PARTITION BY facet ORDER BY n DESC, value) AS place, count(*) OVER (PARTITION BY facet) AS c FROM counts)
SELECT facet, value, n, place::INT AS place, c > 11 AND place > 10 AS hidden FROM placed""")
def facet_values_shown(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = catalog.facet_counts(products(spark, sf_dir), REQUEST, FACETS)
    return catalog.visible_values(counts).select("facet", "value", "n", "place", "hidden")


@query(f"{_COUNTS} SELECT facet, bool_and(length(value) <= 3) AS pills FROM counts GROUP BY facet")
def facet_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.pill_layout(catalog.facet_counts(products(spark, sf_dir), REQUEST, FACETS))


@query(f"""{_COUNTS}, b AS (SELECT facet, bool_and(length(value) <= 3) AND facet <> 'p_size' AS pills FROM counts GROUP BY facet),
placed AS (SELECT *, row_number() OVER (PARTITION BY facet ORDER BY n DESC, value) AS place, count(*) OVER (PARTITION BY facet) AS c FROM counts)
SELECT facet, value, n, place::INT AS place, CASE facet WHEN 'p_brand' THEN false WHEN 'p_type' THEN c > 7 AND place > 6 ELSE c > 11 AND place > 10 END AS hidden, pills FROM placed JOIN b USING (facet)""")
def facet_presentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands as swatches without labels, types as images, sizes as if boolean, which are never pills."""
    counts = catalog.facet_counts(products(spark, sf_dir), REQUEST, FACETS)
    values = catalog.visible_values(counts, swatches=["p_brand"], images=["p_type"]).select("facet", "value", "n", "place", "hidden")
    return values.join(catalog.pill_layout(counts, booleans=["p_size"]), "facet")


@query("""WITH v AS (SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey % 700 * 100 END AS lo, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey % 900 * 100 + 5 END AS hi FROM orders),
s AS (SELECT o_orderkey, lo IS NULL AND hi IS NULL AS none, coalesce(lo, 0)::BIGINT AS a, coalesce(hi, 123456)::BIGINT AS b FROM v)
SELECT o_orderkey, CASE WHEN none THEN '' ELSE '$' || format('{:,}', a // 100) || '.' || lpad((a % 100)::VARCHAR, 2, '0') || '–$' || format('{:,}', b // 100) || '.' || lpad((b % 100)::VARCHAR, 2, '0') END AS summary FROM s""")
def range_summary_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    shown = range_text(F.when(key % 4 != 0, key % 700 * 100), F.when(key % 3 != 0, key % 900 * 100 + 5), F.lit(123456).cast("long"), "${{ amount }}", F.lit("USD"))
    return read(spark, sf_dir, "orders").select("o_orderkey", shown.alias("summary"))


@query("SELECT page_id, url FROM pages WHERE regexp_matches(lower(url), '(^|[^\\p{L}\\p{N}])example($|[^\\p{L}\\p{N}])') AND regexp_matches(lower(url), '(^|[^\\p{L}\\p{N}])com')")
def search_punctuation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages").filter(text.all_terms_match(F.col("url"), "Example.com")).select("page_id", "url")


@query(f"WITH {PRODUCT}, back AS (SELECT p_partkey, p_name, price FROM product WHERE {LISTS} AND (p_name < 'red' OR p_name = 'red' AND p_partkey < 100) ORDER BY p_name DESC, p_partkey DESC LIMIT 24) SELECT * FROM back ORDER BY p_name, p_partkey")
def cursor_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page before a place in the list, as when a reader scrolls up."""
    own = CatalogRequest(filters=REQUEST.filters, sort="title-ascending")
    place = catalog.Cursor(own.normalized().key(), ("red", 100), forward=False)
    return catalog.cursor_page(products(spark, sf_dir), own, FACETS, catalog.Cursor.of(place.text())).select("p_partkey", "p_name", "price")


@query("""SELECT o_orderkey, (CASE WHEN o_orderkey % 3 = 0 OR o_orderkey % 5 = 0 THEN 1 ELSE 0 END + CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END
  + CASE WHEN o_orderkey % 2 = 0 THEN 2 ELSE 0 END)::INT AS active FROM orders""")
def active_facet_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order stands for a request: a price range with bounds by its key, a boolean by its status, a list by parity."""
    none = F.lit(None).cast("long")
    facet = lambda kind, low, high, values: F.struct(F.lit(kind).alias("type"), low.alias("low"), high.alias("high"), values.alias("values"))
    key, empty = F.col("o_orderkey"), F.array().cast("array<string>")
    filters = F.array(
        facet("price_range", F.when(key % 3 == 0, key), F.when(key % 5 == 0, key), empty),
        facet("boolean", none, none, F.array(F.when(F.col("o_orderstatus") == "F", "true").otherwise("false"))),
        facet("list", none, none, F.when(key % 2 == 0, F.array(F.lit("a"), F.lit("b"))).otherwise(empty)),
    )
    return read(spark, sf_dir, "orders").select("o_orderkey", catalog.active_value_count(filters).alias("active"))


@query("""WITH v AS (SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey % 700 - 100 END AS lo, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey % 900 END AS hi FROM orders)
SELECT o_orderkey, CASE WHEN lo IS NOT NULL THEN greatest(0, least(lo, coalesce(hi, 800))) END::BIGINT AS low,
  CASE WHEN hi IS NOT NULL THEN greatest(coalesce(lo, 0), least(hi, 800)) END::BIGINT AS high FROM v""")
def price_bounds_clamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    low, high = clamp_bounds(F.when(key % 4 != 0, key % 700 - 100), F.when(key % 5 != 0, key % 900), F.lit(800).cast("long"))
    return read(spark, sf_dir, "orders").select("o_orderkey", low.alias("low"), high.alias("high"))


# Search and matching

_TERMS = r"""list_contains(string_split_regex(lower({c}), '[^\p{{L}}\p{{N}}]+'), 'the') AND len(list_filter(string_split_regex(lower({c}), '[^\p{{L}}\p{{N}}]+'), lambda w: starts_with(w, 'ean'))) > 0"""
_STARTS = r"""len(list_filter(string_split_regex(lower({c}), '[^\p{{L}}\p{{N}}]+'), lambda w: starts_with(w, 's'))) > 0"""
_RESOURCES = (("product", "part", "p_partkey", "p_name"), ("page", "pages", "page_id", "url"), ("supplier", "supplier", "s_suppkey", "s_name"), ("document", "documents", "doc_id", "text"))


def resources(spark: SparkSession, sf_dir: str) -> dict[str, tuple[DataFrame, str, str]]:
    return {kind: (read(spark, sf_dir, name), key, title) for kind, name, key, title in _RESOURCES}


@query(f"SELECT doc_id, lang FROM documents WHERE {_TERMS.format(c='text')}")
def search_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").filter(text.all_terms_match(F.col("text"), "the ean")).select("doc_id", "lang")


@query(" UNION ALL ".join(f"(SELECT '{k}' AS object_type, {i}::BIGINT AS id, {t} AS title FROM {n} WHERE {_STARTS.format(c=t)} ORDER BY title, id LIMIT 4)" for k, n, i, t in _RESOURCES))
def predictive_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.predictive(resources(spark, sf_dir), " s ", 4)


@query(" UNION ALL ".join(f"SELECT '{k}' AS object_type, count(*) AS n FROM {n} WHERE {_STARTS.format(c=t)}" for k, n, i, t in _RESOURCES))
def resource_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.resource_totals(resources(spark, sf_dir), "s")


@query("SELECT p_partkey, p_name FROM part WHERE p_size = 7")
def search_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = products(spark, sf_dir).select("p_partkey", "p_name", "p_size")
    return catalog.or_fallback(rows.filter(text.all_terms_match(F.col("p_name"), "nosuchword")), rows.filter("p_size = 7")).drop("p_size")


@query("SELECT p_partkey, p_name FROM part WHERE p_partkey = 7")
def single_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.only_hit(products(spark, sf_dir).select("p_partkey", "p_name").filter("p_partkey = 7"))


@query("SELECT n_nationkey, strip_accents(lower('Ñé' || n_name || 'Ü')) AS folded, contains(strip_accents(lower('Ñé' || n_name || 'Ü')), 'nenation_1') AS hit FROM nation")
def normalize_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = F.concat(F.lit("Ñé"), F.col("n_name"), F.lit("Ü"))
    return read(spark, sf_dir, "nation").select("n_nationkey", text.normalized(marked).alias("folded"), text.contains_folded(marked, F.lit("nenation_1")).alias("hit"))


@query("""SELECT n_nationkey, contains(lower(n_name), '_1') OR contains('cur' || n_regionkey, '_1') OR 'n' || n_nationkey = '_1' OR starts_with('_' || n_regionkey, '_1') AS shown FROM nation""")
def country_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = F.col("n_regionkey").cast("string")
    aliases = F.array(F.concat(F.lit("_"), region), F.lit("Alias"))
    shown = text.country_matches(F.lit("_1"), F.col("n_name"), F.concat(F.lit("CUR"), region), F.concat(F.lit("N"), F.col("n_nationkey").cast("string")), aliases)
    return read(spark, sf_dir, "nation").select("n_nationkey", shown.alias("shown"))


@query("""WITH s AS (SELECT p_partkey, strpos(lower(p_name), 'ri') AS i FROM part)
SELECT p_partkey, (CASE WHEN i > 0 THEN i - 1 END)::INT AS hit_start, (CASE WHEN i > 0 THEN i + 1 END)::INT AS hit_end FROM s""")
def highlight(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, end = text.highlight(F.col("p_name"), F.lit("RI"))
    return products(spark, sf_dir).select("p_partkey", start.cast("int").alias("hit_start"), end.cast("int").alias("hit_end"))


@query("SELECT DISTINCT 'CUR' || n_regionkey AS currency FROM nation")
def distinct_currencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "nation").select(F.concat(F.lit("CUR"), F.col("n_regionkey").cast("string")).alias("currency")).distinct()


@query("SELECT count(*) > 9 AS many_countries, count(DISTINCT n_regionkey) > 1 AS many_currencies, count_if(n_nationkey < 3) > 1 AS many_popular FROM nation")
def country_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "nation").agg(
        (F.count("*") > 9).alias("many_countries"), (F.count_distinct("n_regionkey") > 1).alias("many_currencies"), (F.count_if(F.col("n_nationkey") < 3) > 1).alias("many_popular")
    )


# Lookups


@query("""WITH w(pos, id) AS (VALUES (0, '12'), (1, '3'), (2, 'x'), (3, '999999999'), (4, '3'), (5, NULL))
SELECT pos, p_partkey, p_name FROM w LEFT JOIN part ON try_cast(id AS BIGINT) = p_partkey""")
def ordered_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.ordered_lookup(products(spark, sf_dir), "p_partkey", [12, "3", "x", 999999999, 3, None]).select("pos", "p_partkey", "p_name")


@query("SELECT l.doc_id, lang, n_chars FROM labels l JOIN documents d USING (doc_id) WHERE quality = 1 AND lang = 'en' ORDER BY doc_id LIMIT 6")
def staff_picks(spark: SparkSession, sf_dir: str) -> DataFrame:
    picks, docs = read(spark, sf_dir, "labels").filter("quality = 1").select("doc_id"), read(spark, sf_dir, "documents").filter("lang = 'en'").select("doc_id", "lang", "n_chars")
    return lookups.pick_existing(picks, docs, "doc_id", ["doc_id"], 6)


_LINES = "line AS (SELECT l_orderkey AS cart_id, l_linenumber AS line, l_partkey AS variant_id, l_quantity::INT AS quantity, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS price, l_discount, l_returnflag FROM lineitem)"


def cart_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("cart_id"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("variant_id"), F.col("l_quantity").cast("int").alias("quantity"),
        minor_units(F.col("l_extendedprice")).alias("price"), "l_discount", "l_returnflag",
    )


@query(f"""WITH {_LINES} SELECT p_partkey AS variant_id, coalesce(sum(quantity), 0)::BIGINT AS in_cart, min((cart_id, line))[1] AS first_cart
FROM part LEFT JOIN line ON variant_id = p_partkey GROUP BY p_partkey""")
def variant_cart_qty(spark: SparkSession, sf_dir: str) -> DataFrame:
    variants = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("variant_id"))
    found = lookups.quantities(variants, cart_lines(spark, sf_dir), "variant_id", "quantity", ("cart_id", "line"))
    return found.select("variant_id", "in_cart", F.col("first_line.cart_id").alias("first_cart"))


@query(f"WITH {_LINES} SELECT cart_id, sum(quantity)::BIGINT AS items, sum(price)::BIGINT AS total_price FROM line GROUP BY cart_id")
def cart_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cart.totals(cart_lines(spark, sf_dir), ["cart_id"], F.col("quantity"), F.col("price"))


@query(f"WITH {_LINES} SELECT coalesce(sum(quantity), 0)::BIGINT AS items FROM line WHERE l_returnflag = 'R'")
def item_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cart_lines(spark, sf_dir).filter("l_returnflag = 'R'").agg(F.coalesce(F.sum("quantity"), F.lit(0).cast("long")).alias("items"))


@query("""SELECT DISTINCT cart_id, code FROM (
  SELECT o_orderkey AS cart_id, 'ORDER-' || o_orderstatus AS code FROM orders WHERE o_orderkey % 2 = 0
  UNION ALL SELECT l_orderkey, 'SAVE' || CAST(round(l_discount * 100) AS INT) FROM lineitem WHERE l_discount > 0)""")
def discount_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines = read(spark, sf_dir, "orders"), read(spark, sf_dir, "lineitem")
    kind = lambda condition: F.when(condition, "discount_code").otherwise("automatic").alias("type")
    own = orders.select(F.col("o_orderkey").alias("cart_id"), kind(F.col("o_orderkey") % 2 == 0), F.concat(F.lit("ORDER-"), F.col("o_orderstatus")).alias("code"))
    percent = F.round(F.col("l_discount") * 100).cast("int").cast("string")
    each = lines.select(F.col("l_orderkey").alias("cart_id"), kind(F.col("l_discount") > 0), F.concat(F.lit("SAVE"), percent).alias("code"))
    return cart.discount_codes(own, each)


@query("""SELECT conv_id, turn::BIGINT AS turn FROM conversations WHERE conv_id % 3 = 0 AND (turn = 0 OR turn = 1)""")
def cascade_remove(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turn 0 of some conversations goes, and with it its reply."""
    key = lambda turn: F.concat_ws(":", "conv_id", turn.cast("string"))
    lines = read(spark, sf_dir, "conversations").select("conv_id", whole("turn").alias("turn")).withColumn("key", key(F.col("turn"))).withColumn("parent", key(F.when(F.col("turn") == 1, F.lit(0)).otherwise(F.lit(-1))))
    removed = lines.filter("conv_id % 3 = 0 and turn = 0").select("key")
    return lookups.cascade(lines, removed, "key", "parent").select("conv_id", "turn")


@query("SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 45)")
def media_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    used = read(spark, sf_dir, "lineitem").filter("l_quantity >= 45").select(F.col("l_partkey").alias("p_partkey"))
    return lookups.without(read(spark, sf_dir, "part").select("p_partkey"), used, ["p_partkey"])


@query("SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY CASE WHEN l_linenumber = 2 THEN 0 ELSE 1 END, l_linenumber, l_partkey)::INT AS place FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey FROM lineitem)")
def media_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    media = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey").distinct().withColumn("pos", F.struct("l_linenumber", "l_partkey"))
    return lookups.front_first(media, ["l_orderkey"], F.col("l_linenumber") == 2, "pos").select("l_orderkey", "l_linenumber", "place")


@query("""SELECT a.o_orderpriority, a.o_orderkey AS left_key, b.o_orderkey AS right_key
FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS i FROM orders WHERE o_orderstatus = 'F') a
JOIN (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS i FROM orders WHERE o_orderstatus = 'O') b
ON a.o_orderpriority = b.o_orderpriority AND a.i = b.i""")
def keyed_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    side = lambda status, name: read(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == status).select("o_orderpriority", F.col("o_orderkey").alias(name))
    return lookups.zip_by_key(side("F", "left_key"), side("O", "right_key"), "o_orderpriority", "left_key", "right_key")


@query(f"""WITH {PRODUCT}, x AS (SELECT p_brand, p_type, min((p_size, p_partkey)) AS m FROM product WHERE price > 95000 GROUP BY ALL)
SELECT DISTINCT p.p_partkey, coalesce(CASE WHEN p.p_partkey % 3 = 0 THEN p.p_partkey END, CASE WHEN p.p_partkey % 5 = 0 THEN p.p_size::BIGINT END, x.m[2]) AS medium
FROM product p LEFT JOIN x USING (p_brand, p_type)""")
def swatch_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A part's own medium (every third has one), its product's (every fifth), else that of the first available part of its
    brand and type, in the order of size and key."""
    parts = products(spark, sf_dir)
    first = lookups.first_with(parts.select("p_brand", "p_type", "p_size", "p_partkey", "price"), ["p_brand", "p_type"], ["p_size", "p_partkey"], F.col("price") > 95000)
    joined = parts.select("p_partkey", "p_brand", "p_type", "p_size").join(first.select("p_brand", "p_type", F.col("p_partkey").alias("other")), ["p_brand", "p_type"], "left")
    own = F.when(F.col("p_partkey") % 3 == 0, F.col("p_partkey"))
    return joined.select("p_partkey", F.coalesce(own, F.when(F.col("p_partkey") % 5 == 0, whole("p_size")), "other").alias("medium"))


# Rules


def with_breaks(rows: DataFrame, price: str) -> DataFrame:
    each = lambda q, percent: F.struct(F.lit(q).alias("minimum_quantity"), F.expr(f"{price} * {percent} div 100").alias("price"))
    return rows.withColumn("breaks", F.array(*(each(*b) for b in BREAKS)))


_TIERS = f"tiered AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity::INT AS q, price FROM lineitem JOIN product ON l_partkey = p_partkey)"


def tiered(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").cast("int").alias("q"))
    return with_breaks(lines.join(products(spark, sf_dir).select(F.col("p_partkey").alias("l_partkey"), "price"), "l_partkey"), "price")


@query(f"WITH {PRODUCT}, {_TIERS} SELECT l_orderkey, l_linenumber, q, CASE WHEN q >= 40 THEN price * 80 // 100 WHEN q >= 25 THEN price * 90 // 100 WHEN q >= 10 THEN price * 95 // 100 ELSE price END AS unit_price FROM tiered")
def tier_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiered(spark, sf_dir).select("l_orderkey", "l_linenumber", "q", rules.tier_price(F.col("breaks"), F.col("price"), F.col("q")).alias("unit_price"))


@query(f"WITH {PRODUCT}, {_TIERS} SELECT l_orderkey, l_linenumber, q, CASE WHEN q >= 40 THEN price * 80 // 100 WHEN q >= 25 THEN price * 90 // 100 ELSE price * 95 // 100 END AS unit_price FROM tiered")
def tier_price_descending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiered(spark, sf_dir).select("l_orderkey", "l_linenumber", "q", rules.tier_price_descending(F.col("breaks"), F.col("q")).alias("unit_price"))


@query(f"WITH {PRODUCT}, {_TIERS} SELECT l_orderkey, l_linenumber, q, (CASE WHEN q < 2 THEN NULL WHEN q < 10 THEN 0 WHEN q < 25 THEN 1 WHEN q < 40 THEN 2 ELSE 3 END)::INT AS tier FROM tiered")
def active_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiered(spark, sf_dir).select("l_orderkey", "l_linenumber", "q", rules.active_tier(F.col("breaks"), F.lit(2), F.col("q")).alias("tier"))


@query(f"""WITH {PRODUCT} SELECT p_partkey, (CASE WHEN p_size > 25 THEN price * 80 // 100 ELSE price END)::BIGINT AS low, price AS high FROM product""")
def price_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_breaks(products(spark, sf_dir), "price").withColumn("breaks", F.when(F.col("p_size") > 25, F.col("breaks")).otherwise(F.slice("breaks", 1, 0)))
    low, high = rules.price_bounds(F.col("breaks"), F.col("price"))
    return rows.select("p_partkey", low.alias("low"), high.alias("high"))


_COMPARE = "CASE WHEN p_size % 4 <> 0 THEN price + (p_size % 3 - 1) * 500 END"


def compare_at() -> Column:
    return F.when(F.col("p_size") % 4 != 0, F.col("price") + (F.col("p_size") % 3 - 1) * 500)


@query(f"WITH {PRODUCT} SELECT p_partkey, coalesce({_COMPARE} > price, false) AS on_sale FROM product")
def sale_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products(spark, sf_dir).select("p_partkey", rules.sale_flag(F.col("price"), compare_at()).alias("on_sale"))


@query(f"WITH {PRODUCT} SELECT p_partkey, CASE WHEN p_size = 50 OR p_size % 7 = 0 THEN 'sold_out' WHEN {_COMPARE} > price THEN 'sale' ELSE 'none' END AS badge FROM product")
def badge(spark: SparkSession, sf_dir: str) -> DataFrame:
    available = F.when(F.col("p_size") != 50, F.col("p_size") % 7 != 0)  # null for size 50
    return products(spark, sf_dir).select("p_partkey", rules.badge(available, rules.sale_flag(F.col("price"), compare_at())).alias("badge"))


@query("""SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN CASE WHEN p_partkey % 10 - 3 > 0 THEN CASE WHEN p_partkey % 10 - 3 <= 2 THEN 'low' ELSE 'in_stock' END
  WHEN p_type = 'PROMO' THEN 'in_stock' ELSE 'out_of_stock' END WHEN p_size % 3 = 1 THEN 'in_stock' ELSE 'out_of_stock' END AS status FROM part""")
def inventory_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    status = rules.inventory_status(size % 3 == 0, F.col("p_partkey") % 10 - 3, F.when(F.col("p_type") == "PROMO", "continue"), F.lit(2), size % 3 == 1)
    return read(spark, sf_dir, "part").select("p_partkey", status.alias("status"))


@query("""WITH v AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity::INT AS v, (l_partkey % 3 + 1)::INT AS mn, (l_partkey % 4 + 1)::INT AS st,
  CASE WHEN l_partkey % 5 <> 0 THEN (l_partkey % 40 + 5)::INT END AS mx, (l_orderkey % 6)::INT AS c FROM lineitem),
w AS (SELECT *, CASE WHEN mx IS NOT NULL THEN greatest(mx - c, mn) END AS em, CASE WHEN (v - mn) % st <> 0 THEN mn + floor((v - mn) / st)::INT * st ELSE v END AS sn FROM v)
SELECT l_orderkey, l_linenumber, l_partkey, em AS most, greatest(mn, least(coalesce(em, sn), sn)) AS snapped, least(coalesce(em, greatest(mn, v + st)), greatest(mn, v + st)) AS stepped,
  NOT coalesce(c + v > mx, false) AS can_add, mn > 1 OR st > 1 OR mx IS NOT NULL AS has_rule FROM w""")
def quantity_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, value = F.col("l_partkey"), F.col("v")
    rows = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").cast("int").alias("v"), (part % 3 + 1).cast("int").alias("mn"), (part % 4 + 1).cast("int").alias("st"),
        F.when(part % 5 != 0, part % 40 + 5).cast("int").alias("mx"), (F.col("l_orderkey") % 6).cast("int").alias("c"),
    )
    low, step, high, held = F.col("mn"), F.col("st"), F.col("mx"), F.col("c")
    rows = rows.withColumn("most", rules.effective_max(low, high, held))
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", "most", rules.snap_quantity(value, low, step, F.col("most")).alias("snapped"), rules.step_quantity(value, low, step, F.col("most"), 1).alias("stepped"),
        rules.can_add(value, high, held).alias("can_add"), rules.has_quantity_rule(low, step, high).alias("has_rule"),
    )


@query("""WITH r AS (SELECT s_suppkey, CAST(s_suppkey % 500 AS DECIMAL(9,2)) / 100 AS r FROM supplier), f AS (SELECT s_suppkey, CAST(r AS DECIMAL(9,2)) AS r FROM r)
SELECT s_suppkey, (floor(r) + CASE WHEN r - floor(r) >= 0.3 THEN 1 ELSE 0 END)::BIGINT AS filled,
  CASE WHEN r - floor(r) > 0.7 THEN 1.0 WHEN r - floor(r) >= 0.3 THEN 0.5 ELSE 0.0 END::DOUBLE AS last_star FROM f""")
def star_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    rating = ((F.col("s_suppkey") % 500).cast("decimal(9,2)") / 100).cast("decimal(9,2)")
    return read(spark, sf_dir, "supplier").select("s_suppkey", rules.filled_stars(rating).cast("long").alias("filled"), rules.star_fraction(rating).alias("last_star"))


@query("SELECT p_partkey, p_size, (CASE WHEN p_size <= 7 THEN 5 WHEN p_size <= 15 THEN 10 WHEN p_size <= 30 THEN 20 ELSE 40 END)::INT AS nearest FROM part")
def nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select("p_partkey", "p_size", curation.nearest(F.array(*map(F.lit, (5, 10, 20, 40))), F.col("p_size")).alias("nearest"))


_TYPED = """WITH p AS (SELECT p_partkey, (CAST(CAST(p_retailprice AS DECIMAL(18,2)) * 100 AS BIGINT) * (p_partkey % 900 + 1)) AS v, p_partkey % 6 AS kind FROM part),
t AS (SELECT p_partkey, kind, v, CASE kind WHEN 0 THEN format('{:,}', v // 100) || '.' || lpad((v % 100)::VARCHAR, 2, '0') WHEN 1 THEN replace(format('{:,}', v // 100), ',', '.') || ',' || (v % 100) // 10
  WHEN 2 THEN '$ ' || replace(format('{:,}', v // 100), ',', ' ') WHEN 3 THEN format('{:,}', v // 1000) || '.' || lpad((v % 1000)::VARCHAR, 3, '0') WHEN 4 THEN '¥' || format('{:,}', v // 100) ELSE 'none' END AS typed,
  CASE kind WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'EUR' WHEN 3 THEN 'KWD' WHEN 4 THEN 'JPY' ELSE 'USD' END AS currency FROM p)"""


@query(f"""{_TYPED} SELECT p_partkey, typed, currency, (CASE kind WHEN 0 THEN v WHEN 1 THEN v // 100 * 100 + v % 100 // 10 * 10 WHEN 3 THEN v WHEN 4 THEN v // 100
  WHEN 2 THEN v // 100 * 100 END)::BIGINT AS minor FROM t""")
def money_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts as people of several places type them, from parts' prices; the SQL knows the amounts, the query only the text."""
    v, kind = F.col("price") * (F.col("p_partkey") % 900 + 1), F.col("p_partkey") % 6
    whole_ = lambda n, mark: F.replace(F.format_number(n, 0), F.lit(","), F.lit(mark))
    div = lambda n: F.expr(f"price * (p_partkey % 900 + 1) div {n}")
    typed = F.when(kind == 0, F.concat(whole_(div(100), ","), F.lit("."), F.lpad((v % 100).cast("string"), 2, "0")))
    typed = typed.when(kind == 1, F.concat(whole_(div(100), "."), F.lit(","), F.expr("price * (p_partkey % 900 + 1) % 100 div 10").cast("string")))
    typed = typed.when(kind == 2, F.concat(F.lit("$ "), whole_(div(100), " "))).when(kind == 3, F.concat(whole_(div(1000), ","), F.lit("."), F.lpad((v % 1000).cast("string"), 3, "0")))
    rows = products(spark, sf_dir).select("p_partkey", typed.when(kind == 4, F.concat(F.lit("¥"), whole_(div(100), ","))).otherwise("none").alias("typed"), kind.alias("kind"))
    currency = F.when(F.col("kind").isin(1, 2), "EUR").when(F.col("kind") == 3, "KWD").when(F.col("kind") == 4, "JPY").otherwise("USD")
    own = rows.select("p_partkey", "typed", currency.alias("currency"))
    return own.withColumn("minor", money.parse_money(F.col("typed"), F.col("currency")))


@query(f"""WITH {PRODUCT}, m AS (SELECT p_partkey, price * 137 * (CASE WHEN p_size % 5 = 0 THEN -1 ELSE 1 END) AS v FROM product),
x AS (SELECT *, format('{{:,}}', abs(v) // 100) AS w, lpad((abs(v) % 100)::VARCHAR, 2, '0') AS f, format('{{:,}}', (abs(v) + 50) // 100) AS n, CASE WHEN v < 0 THEN '-' ELSE '' END AS s FROM m)
SELECT p_partkey, '$' || s || w || '.' || f || ' USD' AS us, s || replace(w, ',', '.') || ',' || f AS eu, s || n AS plain, s || replace(w, ',', '''') || '.' || f AS ch FROM x""")
def money_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.col("price") * 137 * F.when(F.col("p_size") % 5 == 0, -1).otherwise(1)
    show = lambda template, name: money.format_money(value, template, F.lit("USD")).alias(name)
    return products(spark, sf_dir).select(
        "p_partkey", show("${{ amount }} {{currency}}", "us"), show("{{amount_with_comma_separator}}", "eu"), show("{{ amount_no_decimals }}", "plain"), show("{{amount_with_apostrophe_separator}}", "ch")
    )


@query(f"WITH {PRODUCT} SELECT p_brand, CASE WHEN max(price) > min(price) AND count(*) % 2 = 0 THEN min(price) END AS from_price FROM product GROUP BY p_brand")
def from_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = products(spark, sf_dir).groupBy("p_brand").agg(F.min("price").alias("low"), F.max("price").alias("high"), (F.count("*") % 2 != 0).alias("swatches"))
    return rows.select("p_brand", rules.from_price(F.col("low"), F.col("high"), F.col("swatches")).alias("from_price"))


@query(f"""WITH {PRODUCT} SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN price WHEN {_COMPARE} > price THEN {_COMPARE} END AS struck FROM product""")
def line_price_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    final = F.col("price") - F.when(F.col("p_size") % 2 == 0, 100).otherwise(0)
    return products(spark, sf_dir).select("p_partkey", rules.struck_price(F.col("price"), final, compare_at()).alias("struck"))


@query("""SELECT event_id, to_json(map_from_entries(list_filter([('k', json_extract_string(props, '$.k')), ('file', CASE WHEN event_id % 2 = 0 THEN event_id || '.png' END)], lambda x: x[2] IS NOT NULL)))::VARCHAR AS shown FROM events""")
def visible_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event properties with a hidden one, an empty one and, for even ids, an upload."""
    own = F.get_json_object("props", "$.k")
    path = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("/uploads/a/"), F.col("event_id").cast("string"), F.lit(".png"))).otherwise("")
    properties = F.create_map(F.lit("k"), own, F.lit("_hidden"), F.lit("x"), F.lit("empty"), F.lit(" "), F.lit("file"), path)
    return read(spark, sf_dir, "events").select("event_id", F.to_json(rules.visible_properties(properties)).alias("shown"))


# Curation


@query(f"""SELECT event_id, strftime(ts, '%Y-%m-%d') AS day FROM events WHERE strftime(ts, '%Y-%m-%d') >= '{TODAY}' ORDER BY day, event_id::VARCHAR LIMIT 20""")
def upcoming_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.upcoming(read(spark, sf_dir, "events"), F.col("ts"), TODAY, F.col("event_id"), 20).select("event_id", "day")


@query("""WITH v AS (SELECT user_id, json_extract_string(props, '$.k') AS item, max((ts, event_id)) AS latest FROM events WHERE event_type = 'view' GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY latest DESC) AS place FROM v) SELECT user_id, item, place::INT AS place FROM r WHERE place <= 4""")
def recently_viewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = read(spark, sf_dir, "events").filter("event_type = 'view'").withColumn("item", F.get_json_object("props", "$.k"))
    return curation.recently_viewed(views, "user_id", "item", ("ts", "event_id"))


@query("SELECT p_partkey, p_name FROM part WHERE p_partkey <> 1 ORDER BY p_partkey LIMIT 8")
def rec_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.recommendation_fallback(products(spark, sf_dir).select("p_partkey", "p_name"), "p_partkey", 1, "related", 8)


@query("""WITH o AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem), c AS (SELECT a.l_partkey, b.l_partkey AS other, count(*) AS n FROM o a JOIN o b ON a.l_orderkey = b.l_orderkey AND a.l_partkey <> b.l_partkey GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY n DESC, other) AS place FROM c) SELECT l_partkey, other, n, place::INT AS place FROM r WHERE place <= 4""")
def recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem")
    return stored_in(curation.bought_together(lines, "l_orderkey", "l_partkey", 4), "recommendations", 1 + lines.count() // ROWS_A_TASK)


@query(f"WITH {PRODUCT} SELECT p_partkey, CASE WHEN p_size % 3 = 0 AND p_size % 2 <> 0 THEN round(price * 9 / 10.0)::BIGINT ELSE price END AS price FROM product")
def member_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags = F.array_compact(F.array(F.when(F.col("p_size") % 3 == 0, "active-subscription"), F.when(F.col("p_size") % 2 == 0, "renter")))
    return products(spark, sf_dir).select("p_partkey", curation.member_price(F.col("price"), tags).alias("price"))


@query("SELECT l_partkey, count_if(l_returnflag <> 'R')::BIGINT AS copies, count_if(l_returnflag = 'A')::BIGINT AS available FROM lineitem GROUP BY l_partkey")
def availability(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("l_returnflag") == "R", "Sold").when(F.col("l_returnflag") == "A", "Available").otherwise("Held")
    return curation.availability(read(spark, sf_dir, "lineitem").select("l_partkey", status.alias("status")), "l_partkey")


# Sources, sinks and event folds


@query("SELECT event_id FROM events WHERE 1705276800000 - epoch_ms(ts) < 86400000")
def session_ttl(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = read(spark, sf_dir, "events").withColumn("timestamp", F.unix_millis(F.col("ts").cast("timestamp")))
    return alive(entries, 1705276800000, 86_400_000).select("event_id")


@query(f"WITH {_LINES}, one AS (SELECT cart_id, variant_id, sum(quantity)::INT AS quantity FROM line GROUP BY ALL) SELECT cart_id, variant_id, CASE WHEN cart_id % 3 = 0 THEN (variant_id % 4)::INT ELSE quantity END AS quantity FROM one WHERE NOT (cart_id % 3 = 0 AND variant_id % 4 = 0)")
def cart_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = cart_lines(spark, sf_dir).groupBy("cart_id", "variant_id").agg(F.sum("quantity").cast("int").alias("quantity"))
    changes = lines.filter("cart_id % 3 = 0").select("cart_id", "variant_id", (F.col("variant_id") % 4).cast("int").alias("quantity"))
    return upsert(lines, changes, ["cart_id", "variant_id"])


@query("""SELECT p_partkey, '{"p_partkey":' || p_partkey || ',"p_name":"' || p_name || '","p_size":' || p_size || '}' AS json FROM part""")
def json_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_json_rows(read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size"), ["p_partkey"])


@query("SELECT event_id, user_id FROM events WHERE user_id IS DISTINCT FROM 7")
def self_echo(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events").withColumn("source_id", F.col("user_id").cast("string"))
    return folds.from_others(rows, "source_id", "7").select("event_id", "user_id")


@query("""WITH d AS (SELECT *, CASE WHEN ts < lag(ts) OVER w + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts)),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id, event_type ORDER BY ts) AS burst FROM d)
SELECT user_id, event_type, max_by(event_id, (ts, event_id)) AS payload, count(*) AS calls FROM g GROUP BY user_id, event_type, burst""")
def debounce(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return folds.debounced(rows, "ts", ["user_id", "event_type"], "30 minutes", F.col("event_id"), tie="event_id").select("user_id", "event_type", "payload", "calls")


@query("SELECT user_id, event_type, max_by(value, (ts, event_id)) AS value FROM events GROUP BY user_id, event_type")
def latest_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.latest(read(spark, sf_dir, "events"), ["user_id", "event_type"], "ts", "event_id", ["value"])


@query("""WITH e AS (SELECT user_id, ts, event_id, event_type = 'purchase' AS form, (event_id % 5)::BIGINT AS n FROM events),
s AS (SELECT user_id, max((ts, event_id)) AS latest, max_by(n, (ts, event_id)) AS v FROM e WHERE NOT form GROUP BY user_id)
SELECT user_id, (coalesce(any_value(v), 0) + sum(CASE WHEN form AND coalesce((ts, event_id) > latest, true) THEN n ELSE 0 END))::BIGINT AS count FROM e LEFT JOIN s USING (user_id) GROUP BY user_id""")
def optimistic_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events").select("user_id", "ts", "event_id", (F.col("event_type") == "purchase").alias("form"), (F.col("event_id") % 5).alias("n"))
    return folds.optimistic_counts(rows, ["user_id"], ["ts", "event_id"], "form", "n")


@query("""WITH d AS (SELECT DISTINCT p_size AS size FROM part) SELECT size, lag(size) OVER (ORDER BY size) AS smaller FROM d""")
def next_smaller(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes are few (a rule's values); each with the next smaller one."""
    sizes = read(spark, sf_dir, "part").select(F.col("p_size").alias("size")).distinct()
    return sizes.withColumn("smaller", F.lag("size").over(Window.orderBy("size")))


@query(r"""SELECT p_partkey, upper(p_name[1]) || lower(p_name[2:]) AS capital, regexp_replace(regexp_replace(lower(p_brand || ' ' || p_name), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g') AS handle,
  CASE WHEN length(p_name) > 8 THEN p_name[1:5] || '...' ELSE p_name END AS short, CASE WHEN p_size = 1 THEN '1 item' ELSE p_size || ' items' END AS items,
  CASE WHEN p_size % 2 = 0 THEN 'none' ELSE p_type END AS kind FROM part""")
def string_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, size = F.col("p_name"), F.col("p_size")
    return read(spark, sf_dir, "part").select(
        "p_partkey", text.capitalize(name).alias("capital"), text.handleize(F.concat_ws(" ", "p_brand", "p_name")).alias("handle"), text.truncate(name, 8).alias("short"),
        rules.plural(size, "{{ count }} item", "{{ count }} items").alias("items"), rules.default_to(F.when(size % 2 == 0, "").otherwise(F.col("p_type")), F.lit("none")).alias("kind"),
    )


@query("""WITH c AS (SELECT l_orderkey, list_sort(list_distinct(list('C' || (l_partkey % 4)))) AS codes FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, array_to_string(CASE WHEN list_contains(codes, 'C1') THEN codes ELSE list_append(codes, 'C1') END, ',') AS added, array_to_string(list_filter(codes, lambda x: x <> 'C2'), ',') AS removed,
  len(codes) = 2 AND list_contains(codes, 'C0') AND list_contains(codes, 'C3') AS same FROM c""")
def set_edit(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_set(F.concat(F.lit("C"), (F.col("l_partkey") % 4).cast("string")))).alias("codes"))
    return codes.select(
        "l_orderkey",
        F.array_join(lookups.add_if_absent(F.col("codes"), F.lit("C1")), ",").alias("added"),
        F.array_join(lookups.remove_first(F.col("codes"), F.lit("C2")), ",").alias("removed"),
        lookups.set_equal(F.col("codes"), F.array(F.lit("C3"), F.lit("C0"))).alias("same"),
    )


@query("SELECT p_partkey, i AS component_pos, p_brand || '-' || i AS component FROM part, range(0, 3) r(i) WHERE i < p_size % 4")
def bundle_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array(*(F.concat_ws("-", "p_brand", F.lit(str(i))) for i in range(3)))
    rows = read(spark, sf_dir, "part").select("p_partkey", F.slice(names, F.lit(1), F.least(F.lit(3), F.col("p_size") % 4)).alias("parts"))
    return cart.component_lines(rows, "parts").withColumn("component_pos", F.col("component_pos").cast("long"))


@query("SELECT l_orderkey, l_linenumber, l_quantity::INT AS quantity, CASE WHEN l_quantity::INT > 1 THEN ' × ' || l_quantity::INT ELSE '' END AS shown FROM lineitem")
def component_quantities(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantity = F.col("l_quantity").cast("int")
    shown = F.coalesce(F.concat(F.lit(" × "), cart.visible_component_quantity(quantity).cast("string")), F.lit(""))
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", quantity.alias("quantity"), shown.alias("shown"))


# Template filters


@query("""WITH l AS (SELECT l_orderkey, list({'n': l_linenumber, 'q': l_quantity::INT, 'f': CASE WHEN l_returnflag <> 'N' THEN l_returnflag END} ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity::INT, CASE WHEN l_returnflag <> 'N' THEN l_returnflag END NULLS FIRST) AS r FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, len(list_filter(r, lambda x: x.f IS NOT NULL)) AS n_set, len(list_filter(r, lambda x: x.f IS DISTINCT FROM 'R')) AS n_kept, (list_filter(r, lambda x: x.f = 'A')[1]).n AS first_a,
  list_position(list_transform(r, lambda x: x.f IS NOT DISTINCT FROM 'A'), true) - 1 AS index_a, len(list_filter(r, lambda x: x.f = 'R')) > 0 AS has_r, list_sum(list_transform(r, lambda x: x.q))::BIGINT AS quantity,
  r[1].q AS first_q, r[-1].q AS last_q FROM l""")
def array_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """where, reject, find, find_index, has, sum, first and last over the lines of each order."""
    row = F.struct(F.col("l_linenumber").alias("n"), "l_partkey", "l_suppkey", F.col("l_quantity").cast("int").alias("q"), F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("f"))
    rows = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(row)).alias("r"))
    r, a = F.col("r"), F.lit("A")
    return rows.select(
        "l_orderkey", F.size(arrays.where_set(r, "f")).cast("long").alias("n_set"), F.size(arrays.reject(r, "f", F.lit("R"))).cast("long").alias("n_kept"), arrays.find(r, "f", a)["n"].alias("first_a"),
        arrays.find_index(r, "f", a).cast("int").alias("index_a"), arrays.has(r, "f", F.lit("R")).alias("has_r"), arrays.total(r, "q").alias("quantity"), arrays.first(r)["q"].alias("first_q"), arrays.last(r)["q"].alias("last_q"),
    )


@query("""SELECT p_partkey, floor((p_size - 25) / 4)::BIGINT AS quotient, (((p_size - 25) % 7) + 7) % 7 AS rest, abs(p_size - 25) AS size, least(greatest(p_size, 10), 40) AS bounded, ceil(p_size / 3)::BIGINT AS up, round(p_size / 4.0)::BIGINT AS near FROM part""")
def math_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    return read(spark, sf_dir, "part").select(
        "p_partkey", template.divided_by(size - 25, 4).alias("quotient"), template.modulo(size - 25, 7).alias("rest"), F.abs(size - 25).alias("size"),
        template.at_most(template.at_least(size, F.lit(10)), F.lit(40)).alias("bounded"), F.ceil(size / 3).alias("up"), F.round(size.cast("decimal(9,2)") / 4, 0).cast("long").alias("near"),
    )


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS iso, strftime(o_orderdate, '%b %d') AS short, strftime(o_orderdate, '%B %-d, %Y') AS long, o_orderdate::DATE BETWEEN DATE '1998-01-01' AND DATE '1998-01-01' + 90 AS sendable FROM orders")
def date_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate")
    return read(spark, sf_dir, "orders").select(
        "o_orderkey", template.format_date(day, "%Y-%m-%d").alias("iso"), template.format_date(day, "%b %d").alias("short"), template.format_date(day, "%B %e, %Y").alias("long"),
        rules.sendable(day.cast("date"), F.lit("1998-01-01").cast("date")).alias("sendable"),
    )


@query("SELECT p_partkey, CASE WHEN p_size = 1 THEN '1 film' ELSE p_size || ' films' END AS films, CASE WHEN p_type = 'PROMO' THEN 'On promotion' ELSE p_type END AS kind FROM part")
def translate(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = {"films.one": "{{ count }} film", "films.other": "{{ count }} films", "PROMO": "On promotion"}
    return read(spark, sf_dir, "part").select("p_partkey", template.translate(texts, F.lit("films"), F.col("p_size")).alias("films"), template.translate(texts, F.col("p_type")).alias("kind"))


@query("""WITH l AS (SELECT l_orderkey, list_distinct(list(CASE WHEN l_partkey % 2 = 0 THEN upper(p_type) ELSE lower(p_type) END)) AS v FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey)
SELECT l_orderkey, array_to_string(list_transform(list_sort(list_transform(v, lambda x: {'k': lower(x), 'v': x})), lambda s: s.v), ',') AS kinds FROM l""")
def sort_natural(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    cased = F.when(F.col("l_partkey") % 2 == 0, F.upper("p_type")).otherwise(F.lower("p_type"))
    rows = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey").join(parts, "l_partkey").groupBy("l_orderkey").agg(F.collect_set(cased).alias("v"))
    return rows.select("l_orderkey", F.array_join(arrays.sort_natural(F.col("v")), ",").alias("kinds"))


@query("""WITH v AS (SELECT p_brand, p_type, min(p_partkey) AS variant FROM part GROUP BY ALL), s AS (SELECT l_orderkey, l_linenumber, l_partkey, 'Brand#' || (l_partkey % 30) AS b,
  CASE l_partkey % 3 WHEN 0 THEN 'PROMO' WHEN 1 THEN 'SMALL' ELSE 'LARGE' END AS t FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, variant FROM s LEFT JOIN v ON p_brand = b AND p_type = t""")
def variant_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    variants = read(spark, sf_dir, "part").groupBy("p_brand", "p_type").agg(F.min("p_partkey").alias("variant")).select("variant", F.array("p_brand", "p_type").alias("options"))
    part = F.col("l_partkey")
    kind = F.when(part % 3 == 0, "PROMO").when(part % 3 == 1, "SMALL").otherwise("LARGE")
    chosen = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.array(kind, F.concat(F.lit("Brand#"), (part % 30).cast("string"))).alias("options"))
    return lookups.resolve_variants(variants, chosen, "options")


@query("SELECT r.p_partkey AS film, pos::INT AS pos, ref AS p_partkey, q.p_name FROM (SELECT p_partkey, unnest([p_partkey + 1, p_partkey * 7, -1]) AS ref, unnest([0, 1, 2]) AS pos FROM part) r JOIN part q ON ref = q.p_partkey")
def curated_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = read(spark, sf_dir, "part")
    key = F.col("p_partkey")
    refs = parts.select(key.alias("film"), F.array(key + 1, key * 7, F.lit(-1).cast("long")).alias("refs"))
    return curation.curated(refs, "refs", parts.select("p_partkey", "p_name"), "p_partkey")


@query("SELECT l_partkey, l_orderkey, place::INT AS place FROM (SELECT l_partkey, l_orderkey, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey) AS place FROM (SELECT DISTINCT l_partkey, l_orderkey FROM lineitem)) WHERE place > 20")
def surplus_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    copies = read(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey").distinct()
    return curation.surplus_pool(copies, "l_partkey", 20, "l_orderkey")


@query("SELECT * FROM (SELECT 'product' AS object_type, p_partkey AS id, p_name AS title FROM part UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier ORDER BY id, object_type LIMIT 24) WHERE object_type = 'product'")
def mixed_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = read(spark, sf_dir, "part").select(F.lit("product").alias("object_type"), F.col("p_partkey").alias("id"), F.col("p_name").alias("title"))
    more = read(spark, sf_dir, "supplier").select(F.lit("supplier").alias("object_type"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("title"))
    return catalog.mixed_page(own.unionByName(more), [F.asc("id"), F.asc("object_type")], 1, 24, "product")


# Carts, collections and rules


@query(f"WITH {PRODUCT} SELECT p_partkey, p_brand, p_type, p_size FROM product WHERE p_brand IN ('Brand#1', 'Brand#12', 'Brand#23') AND p_type = 'ECONOMY' AND p_size IN (7, 8, 9) AND price BETWEEN 91000 AND 98000")
def request_toggled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A choice is taken away and others are added, one by one."""
    own = REQUEST.toggled("p_type", "PROMO")
    for size in ("7", "8", "9", "10", "10"):
        own = own.toggled("p_size", size)
    return catalog.filtered(products(spark, sf_dir), own, FACETS).select("p_partkey", "p_brand", "p_type", "p_size")


@query("""WITH p AS (SELECT o_orderkey, o_orderkey % 60 + 1 AS pages, least(o_orderkey % 45 + 1, o_orderkey % 60 + 1) AS page FROM orders),
s AS (SELECT o_orderkey, list_sort(list_distinct(list_filter([1, page - 1, page, page + 1, pages], lambda x: x >= 1 AND x <= pages))) AS shown FROM p)
SELECT o_orderkey, array_to_string(list_transform(shown, lambda x, i: CASE WHEN i > 1 AND x - shown[i - 1] > 1 THEN '… ' ELSE '' END || x), ' ') AS links FROM s""")
def page_elision(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = (F.col("o_orderkey") % 60 + 1).cast("int")
    page = F.least((F.col("o_orderkey") % 45 + 1).cast("int"), pages)
    return read(spark, sf_dir, "orders").select("o_orderkey", F.array_join(catalog.page_links_of(page, pages).cast("array<string>"), " ", "…").alias("links"))


@query(f"WITH {PRODUCT} SELECT p_partkey, (CASE WHEN p_size % 3 = 0 THEN price WHEN p_size % 3 = 1 THEN 1250 ELSE 0 END)::BIGINT AS minor FROM product")
def money_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was typed, else what the attribute says, else nothing."""
    kind = F.col("p_size") % 3
    typed = F.when(kind == 0, F.format_number(F.col("price") / 100, 2)).otherwise("free")
    minor = money.parse_money_or(typed, F.when(kind == 1, "12.50"), F.lit("USD"))
    return products(spark, sf_dir).select("p_partkey", minor.alias("minor"))


@query("SELECT event_id, (props->>'k')::INT AS k, NULL::VARCHAR AS absent FROM (SELECT event_id, props::JSON AS props FROM events)")
def inline_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = from_json(read(spark, sf_dir, "events").select("event_id", "props"), "props", "k int, absent string")
    return rows.select("event_id", "props.k", "props.absent")


@query(f"WITH {_LINES}, own AS (SELECT variant_id, sum(quantity)::BIGINT AS quantity FROM line GROUP BY variant_id) SELECT variant_id, CASE variant_id WHEN 2 THEN 5 ELSE quantity END AS quantity FROM own WHERE variant_id NOT IN (1, 3) UNION ALL SELECT 3, 7 UNION ALL SELECT -9, 4")
def cart_update_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All variants' quantities after an update that is given as a map: 1 goes, 2 and 3 are set, one is new."""
    lines = cart_lines(spark, sf_dir).groupBy("variant_id").agg(F.sum("quantity").alias("quantity"))
    updates = F.create_map(*(F.lit(x).cast("long") for x in (1, 0, 2, 5, 3, 7, -9, 4)))
    return upsert_map(lines, updates, "variant_id")


@query("SELECT n_nationkey, true AS shown FROM nation")
def empty_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An empty filter shows all."""
    shown = text.country_matches(F.lit(""), F.col("n_name"), F.lit("CUR"), F.lit("N"), F.array(F.lit("Alias")))
    return read(spark, sf_dir, "nation").select("n_nationkey", shown.alias("shown"))


@query("SELECT l_orderkey, array_to_string(list(l_linenumber ORDER BY l_linenumber, l_partkey, l_suppkey), ',') AS numbers FROM lineitem GROUP BY l_orderkey")
def array_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey"))).alias("r"))
    return rows.select("l_orderkey", F.array_join(arrays.pluck(F.col("r"), "l_linenumber").cast("array<string>"), ",").alias("numbers"))


@query(f"WITH {_LINES}, own AS (SELECT cart_id, variant_id, quantity FROM line UNION ALL SELECT o_orderkey, o_orderkey % 50 + 1, 2 FROM orders WHERE o_orderkey % 4 = 0) SELECT cart_id, variant_id, sum(quantity)::BIGINT AS quantity FROM own GROUP BY ALL")
def cart_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    adds = read(spark, sf_dir, "orders").filter("o_orderkey % 4 = 0").select(F.col("o_orderkey").alias("cart_id"), (F.col("o_orderkey") % 50 + 1).alias("variant_id"), F.lit(2).alias("quantity"))
    return cart.add(cart_lines(spark, sf_dir), adds, ["cart_id", "variant_id"])


@query(f"WITH {_LINES}, one AS (SELECT variant_id, sum(quantity)::BIGINT AS quantity FROM line WHERE cart_id = 1 GROUP BY variant_id), c(variant_id, q) AS (SELECT p_partkey, p_size::BIGINT - 1 FROM part WHERE p_partkey <= 3), m AS (SELECT coalesce(c.variant_id, one.variant_id) AS variant_id, coalesce(q, quantity) AS quantity FROM one FULL JOIN c ON one.variant_id = c.variant_id) SELECT * FROM m WHERE quantity <> 0")
def cart_bulk_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cart 1 after an update of variants 1 to 3."""
    lines = cart_lines(spark, sf_dir).filter("cart_id = 1").groupBy("variant_id").agg(F.sum("quantity").alias("quantity"))
    changes = read(spark, sf_dir, "part").filter("p_partkey <= 3").select(F.col("p_partkey").alias("variant_id"), (whole("p_size") - 1).alias("quantity"))
    return upsert(lines, changes, ["variant_id"])


@query("""WITH e AS (SELECT user_id, ts, event_id, event_type, event_id % 3 AS item, event_id % 5 AS q FROM events),
s AS (SELECT *, last_value(CASE WHEN event_type IN ('view', 'purchase') THEN event_type END IGNORE NULLS) OVER w AS state,
  first_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS released
  FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, released, item, sum(q)::BIGINT AS quantity FROM s WHERE state = 'view' AND event_type NOT IN ('view', 'purchase') AND released IS NOT NULL GROUP BY ALL""")
def queue_while_busy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view begins a change, a purchase ends it, all else adds."""
    rows = read(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", (F.col("event_id") % 3).alias("item"), (F.col("event_id") % 5).alias("q"))
    return folds.queued_while_busy(rows, ["user_id"], ["ts", "event_id"], "event_type", "view", "purchase", "item", "q")


@query("SELECT (" + " + ".join(f"(SELECT count(*) FROM {n} WHERE {_STARTS.format(c=t)})" for _, n, _, t in _RESOURCES) + ")::BIGINT AS n")
def results_of_all_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.one_total(catalog.resource_totals(resources(spark, sf_dir), "s"))


_SINGLE = """len(list_filter(string_split_regex(lower({c}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: starts_with(w, '000000007'))) > 0"""


@query("WITH hit AS (" + " UNION ALL ".join(f"SELECT {i} AS place, '{k}' AS object_type, {key}::BIGINT AS id, {t} AS title FROM {n} WHERE {_SINGLE.format(c=t)}" for i, (k, n, key, t) in enumerate(sorted(_RESOURCES))) + """),
single AS (SELECT place, any_value(object_type) AS object_type, any_value(id) AS id, any_value(title) AS title FROM hit GROUP BY place HAVING count(*) = 1)
SELECT object_type, id, title FROM single WHERE place = (SELECT min(place) FROM single)""")
def single_result_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first kind, by name, that has exactly one row with a word that begins so."""
    found = resources(spark, sf_dir)
    return catalog.single_result(found, "000000007", sorted(found))


@query("""WITH m AS (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey FROM lineitem), f AS (SELECT *, min(l_linenumber) OVER (PARTITION BY l_orderkey) AS first FROM m)
SELECT l_orderkey, l_linenumber, l_partkey FROM f WHERE l_linenumber = first OR l_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 45)""")
def media_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem")
    media = lines.select("l_orderkey", "l_linenumber", "l_partkey").distinct()
    return lookups.media_kept(media, ["l_orderkey"], "l_linenumber", lines.filter("l_quantity >= 45"), ["l_partkey"]).select("l_orderkey", "l_linenumber", "l_partkey")


@query("SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey % 4 = 0")
def pickup_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    rows = read(spark, sf_dir, "supplier").withColumn("pick_up", F.when(key % 3 != 0, key % 4 == 0).when(key % 4 == 0, True))
    return curation.pickup_locations(rows, "pick_up").select("s_suppkey", "s_name")


@query("""WITH c AS (SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS place, ('0' || substr(p_brand, 7))::INT AS b FROM part)
SELECT p_brand, p_partkey, place::INT AS place FROM c WHERE place <= CASE WHEN b % 5 = 0 THEN 7 WHEN b % 5 = 1 THEN 6 WHEN b % 5 = 2 THEN 3 + 2 WHEN b % 5 = 3 THEN 3 ELSE 4 END""")
def collection_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands stand for lists: with a count, with a setting, a carousel, a grid, any other; three columns each."""
    kind = F.substr("p_brand", F.lit(7)).cast("int") % 5
    layout = F.when(kind == 2, "carousel").when(kind == 3, "grid").otherwise("other")
    cap = curation.collection_cap(layout, F.when(kind == 0, 7), F.when(kind <= 1, 6), F.lit(3))
    return curation.capped(read(spark, sf_dir, "part").select("p_brand", "p_partkey"), "p_brand", ["p_partkey"], cap)


@query("SELECT n_nationkey, ['a', 'b', 'c'][n_nationkey % 5 + 1] AS label FROM nation")
def index_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.concat(F.lit("group-"), (F.col("n_nationkey") % 5).cast("string"))
    return read(spark, sf_dir, "nation").select("n_nationkey", lookups.by_index(key, "-", F.array(*map(F.lit, "abc"))).alias("label"))


@query("SELECT p_partkey, p_name, pos::BIGINT AS pos FROM (SELECT l_partkey, min(l_linenumber) AS pos FROM lineitem WHERE l_orderkey % 50 = 0 GROUP BY l_partkey) JOIN part ON l_partkey = p_partkey")
def collection_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some orders' lines stand for a collection: a bridge of products and positions."""
    bridge = read(spark, sf_dir, "lineitem").filter("l_orderkey % 50 = 0").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.min("l_linenumber").cast("long").alias("pos"))
    return lookups.in_collection(bridge, read(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_partkey", "pos").select("p_partkey", "p_name", "pos")


@query("SELECT 'CUR' || n_regionkey AS currency FROM nation GROUP BY 1 ORDER BY min(n_nationkey)")
def currencies_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "nation").select("n_nationkey", F.concat(F.lit("CUR"), F.col("n_regionkey").cast("string")).alias("currency"))
    return lookups.first_seen(rows, "currency", ["n_nationkey"])


@query("SELECT count_if(contains(lower(n_name), '_1'))::BIGINT AS shown FROM nation")
def visible_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = text.country_matches(F.lit("_1"), F.col("n_name"), F.lit("CUR"), F.lit("N"), F.array(F.lit("Alias")))
    return read(spark, sf_dir, "nation").agg(F.count_if(shown).alias("shown"))


@query("SELECT p_type, count(*) AS n FROM part WHERE p_type IN ('ECONOMY', 'PROMO') GROUP BY p_type")
def block_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = lookups.split_by(read(spark, sf_dir, "part"), "p_type", ["ECONOMY", "PROMO"])
    return parts["ECONOMY"].groupBy("p_type").agg(F.count("*").alias("n")).unionByName(parts["PROMO"].groupBy("p_type").agg(F.count("*").alias("n")))


@query(f"WITH {_LINES} SELECT cart_id, line, variant_id, quantity FROM line JOIN (VALUES ('3'), ('12'), ('x')) s(id) ON variant_id::VARCHAR = id")
def cart_items_by_selector(spark: SparkSession, sf_dir: str) -> DataFrame:
    selectors = spark.createDataFrame([("3",), ("12",), ("x",)], "id string").select(F.expr("try_cast(id as long)").alias("variant_id"))
    return lookups.within(cart_lines(spark, sf_dir), selectors, ["variant_id"]).select("cart_id", "line", "variant_id", "quantity")


@query("SELECT p_partkey, p_name FROM part WHERE p_partkey IN (3, 12, 7)")
def id_set_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = spark.createDataFrame([(3,), (12,), (7,), (-1,)], "p_partkey long")
    return lookups.within(read(spark, sf_dir, "part").select("p_partkey", "p_name"), asked, ["p_partkey"])


@query("SELECT o_orderkey, o_orderkey % 40 - 3 BETWEEN 1 AND greatest(1, ceil((o_orderkey % 500) / 24.0)) AS valid FROM orders")
def page_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return read(spark, sf_dir, "orders").select("o_orderkey", catalog.valid_page(key % 40 - 3, key % 500, 24).alias("valid"))


@query("SELECT p_partkey FROM part WHERE p_size > 25")
def boolean_facet(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = products(spark, sf_dir).withColumn("large", F.col("p_size") > 25)
    return catalog.filtered(rows, CatalogRequest(filters={"large": ("true",)}), replace(FACETS, lists=("large",), booleans=("large",))).select("p_partkey")


@query("SELECT o_orderkey, coalesce(o_orderstatus <> 'F', false) AND NOT coalesce(o_orderkey % 7 = 0, false) AS ok FROM orders")
def gift_card_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select("o_orderkey", rules.gift_card_ok(F.col("o_orderstatus") != "F", F.col("o_orderkey") % 7 == 0).alias("ok"))


@query("SELECT o_orderkey, CASE WHEN a AND b THEN 'duties_and_taxes_included' WHEN b THEN 'taxes_included' WHEN a THEN 'duties_included' ELSE 'taxes' END || CASE WHEN d THEN '_discounts' ELSE '' END || CASE WHEN c THEN '_shipping_policy' ELSE '_shipping' END AS note FROM (SELECT o_orderkey, o_orderkey % 2 = 0 AS a, o_orderkey % 3 = 0 AS b, o_orderkey % 5 = 0 AS c, o_orderkey % 7 = 0 AS d FROM orders)")
def tax_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = lambda n: F.col("o_orderkey") % n == 0
    return read(spark, sf_dir, "orders").select("o_orderkey", rules.duties_text(by(2), by(3), by(5), by(7)).alias("note"))


@query(f"SELECT event_id FROM events WHERE ts <= TIMESTAMP '{TODAY} 00:00:00'")
def scheduled_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.published(read(spark, sf_dir, "events"), "ts", F.lit(f"{TODAY} 00:00:00").cast("timestamp_ntz")).select("event_id")


@query("SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0 AND c_custkey % 28 + 1 = 15")
def birthdays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' synthetic birthdays lie in January, every third is a member."""
    key = F.col("c_custkey")
    rows = read(spark, sf_dir, "customer").select("c_custkey", F.array(F.when(key % 3 == 0, "active-subscription").otherwise("none")).alias("tags"), F.make_date(F.lit(1990), F.lit(1), (key % 28 + 1).cast("int")).alias("birthday"))
    return curation.members_with_birthday(rows, F.lit(TODAY).cast("date")).select("c_custkey")


@query("SELECT l_orderkey, l_linenumber, o_custkey FROM lineitem JOIN orders ON o_orderkey % 200 + 1 = l_partkey WHERE l_returnflag = 'R' AND l_partkey <= 20 AND o_orderkey % 11 = 0")
def waitlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returned lines meet the customers who wait for a part."""
    waiting = read(spark, sf_dir, "orders").filter("o_orderkey % 11 = 0").select((F.col("o_orderkey") % 200 + 1).alias("l_partkey"), "o_custkey")
    returned = read(spark, sf_dir, "lineitem").filter("l_returnflag = 'R' and l_partkey <= 20").select("l_orderkey", "l_linenumber", "l_partkey")
    return curation.waitlist_matches(returned, waiting, "l_partkey").select("l_orderkey", "l_linenumber", "o_custkey")


@query(f"WITH {PRODUCT} SELECT l_partkey, l_orderkey, l_linenumber, price * CASE l_returnflag WHEN 'A' THEN 100 ELSE 60 END // 100 AS price FROM lineitem JOIN product ON l_partkey = p_partkey WHERE l_returnflag <> 'R'")
def condition_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Return flags stand for conditions: R is sold, A as new, N used."""
    copies = read(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", F.col("l_returnflag").alias("condition"), F.when(F.col("l_returnflag") == "R", "Sold").otherwise("Available").alias("status"))
    percent = spark.createDataFrame([("A", 100), ("N", 60)], "condition string, percent int")
    priced = curation.condition_prices(copies, percent, "condition").join(products(spark, sf_dir).select(F.col("p_partkey").alias("l_partkey"), "price"), "l_partkey")
    return priced.select("l_partkey", "l_orderkey", "l_linenumber", F.expr("price * percent div 100").alias("price"))


@query("WITH l AS (SELECT l_orderkey, list(l_returnflag = 'R') AS r FROM lineitem GROUP BY l_orderkey) SELECT l_orderkey, len(list_filter(r, lambda x: x))::BIGINT AS returned FROM l")
def array_truthy(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct((F.col("l_returnflag") == "R").alias("returned"))).alias("r"))
    return rows.select("l_orderkey", F.size(arrays.where_true(F.col("r"), "returned")).cast("long").alias("returned"))
