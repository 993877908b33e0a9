"""Vectors for the rules that tables at hand don't reach."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from shelfmark.functions import arrays, money, rules, template, text
from shelfmark.operators import catalog, curation, lookups
from shelfmark.plans.request import CatalogRequest, range_summary
from shelfmark.sources.store import stored_in
from shelfmark.sources.tables import alive, from_json, upsert, upsert_map


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def lit_breaks(*pairs):
    return F.array(*(F.struct(F.lit(q).alias("minimum_quantity"), F.lit(p).alias("price")) for q, p in pairs))


def test_default_replaces_null_empty_and_false(spark):
    assert one(spark, rules.default_to(F.lit(""), F.lit("d"))) == "d"
    assert one(spark, rules.default_to(F.lit(None).cast("string"), F.lit("d"))) == "d"
    assert one(spark, rules.default_to(F.lit("v"), F.lit("d"))) == "v"
    assert one(spark, rules.default_flag(F.lit(False), F.lit(True))) is True


def test_inventory_edges(spark):
    status = lambda *a: one(spark, rules.inventory_status(*(F.lit(x) for x in a)))
    assert status(True, 5, "deny", 5, True) == "low"
    assert status(True, 6, "deny", 5, True) == "in_stock"
    assert status(True, 0, "continue", 5, True) == "in_stock"
    assert status(True, 0, None, 5, True) == "out_of_stock"
    assert status(False, 0, None, 5, False) == "out_of_stock"


def test_tiers_at_and_under_their_bounds(spark):
    breaks = lit_breaks((10, 95), (20, 90))
    price = lambda q: one(spark, rules.tier_price(breaks, F.lit(100), F.lit(q)))
    assert [price(q) for q in (0, 9, 10, 19, 20)] == [100, 100, 95, 95, 90]
    tier = lambda q: one(spark, rules.active_tier(breaks, F.lit(None).cast("int"), F.lit(q)))
    assert [tier(q) for q in (0, 1, 9, 10, 19, 20, 99)] == [None, 0, 0, 1, 1, 2, 2]
    assert one(spark, rules.tier_price_descending(breaks, F.lit(3))) == 95


def test_unsorted_breaks_differ_by_rule(spark):
    breaks = lit_breaks((20, 90), (10, 95))
    assert one(spark, rules.tier_price(breaks, F.lit(100), F.lit(25))) == 95
    assert one(spark, rules.tier_price_descending(breaks, F.lit(25))) == 90


def test_quantity_without_maximum(spark):
    none = F.lit(None).cast("int")
    assert one(spark, rules.snap_quantity(F.lit(8), F.lit(2), F.lit(5), none)) == 7
    assert one(spark, rules.snap_quantity(F.lit(1), F.lit(2), F.lit(5), none)) == 2
    assert one(spark, rules.effective_max(F.lit(3), F.lit(5), F.lit(4))) == 3
    assert one(spark, rules.effective_max(F.lit(3), none, F.lit(4))) is None
    assert one(spark, rules.can_add(F.lit(1), none, F.lit(99))) is True


def test_stars(spark):
    stars = lambda r: one(spark, rules.filled_stars(F.lit(r).cast("decimal(3,2)")))
    assert [stars(r) for r in ("4.29", "4.30", "4.70", "4.71", "5.00")] == [4, 5, 5, 5, 5]
    part = lambda r: one(spark, rules.star_fraction(F.lit(r).cast("decimal(3,2)")))
    assert [part(r) for r in ("4.29", "4.30", "4.70", "4.71")] == [0.0, 0.5, 0.5, 1.0]


def test_money_by_currency(spark):
    show = lambda v, t, c: one(spark, money.format_money(F.lit(v), t, F.lit(c)))
    assert show(1234567, "{{amount}}", "USD") == "12,345.67"
    assert show(1234567, "{{amount}}", "KWD") == "1,234.567"
    assert show(1234567, "{{amount}} {{currency}}", "JPY") == "1,234,567 JPY"
    assert show(250, "{{amount_no_decimals}}", "USD") == "3"
    assert show(50, "{{amount_no_decimals}}", "USD") == "1"
    assert show(5, "{{amount_with_space_separator}}", "USD") == "0,05"
    assert show(123456789, "{{amount_no_decimals_with_space_separator}}", "USD") == "1 234 568"
    assert one(spark, money.parse_money_or(F.lit("x"), F.lit("7"), F.lit("USD"))) == 700
    assert one(spark, money.parse_money_or(F.lit("x"), F.lit(""), F.lit("USD"))) == 0


def test_text_functions(spark):
    assert one(spark, text.normalized(F.lit("Côte d'Ivoire Åé"))) == "cote d'ivoire ae"
    assert one(spark, text.highlight(F.lit("Éclair"), F.lit("cl"))[0]) == 1
    assert one(spark, text.highlight(F.lit("abc"), F.lit(""))[0]) is None
    assert one(spark, text.handleize(F.lit("  A b--C! "))) == "a-b-c"
    assert one(spark, text.truncate_words(F.lit("a b c d"), 2)) == "a b..."
    assert one(spark, text.strip_html(F.lit("<p>a<b>c</b></p><!-- x -->"))) == "ac"
    assert one(spark, text.escape_html(F.lit("<a & 'b'>"))) == "&lt;a &amp; &#39;b&#39;&gt;"
    assert one(spark, text.newline_to_br(F.lit("a\nb"))) == "a<br />\nb"
    assert one(spark, text.basename(F.lit("/x/y.png"))) == "y.png"
    assert one(spark, text.country_matches(F.lit(""), F.lit("x"), F.lit("y"), F.lit("z"), F.array(F.lit("q")))) is True


def test_visible_properties(spark):
    made = F.create_map(*(F.lit(x) for x in ("a", "1", "_b", "2", "c", " ", "d", "/uploads/x/y.png")))
    assert one(spark, rules.visible_properties(made)) == {"a": "1", "d": "y.png"}


def test_dates_and_flags(spark):
    day = lambda s: F.lit(dt.date.fromisoformat(s))
    assert one(spark, rules.sendable(day("2024-03-31"), day("2024-01-01"))) is True
    assert one(spark, rules.sendable(day("2024-04-01"), day("2024-01-01"))) is False
    assert one(spark, rules.gift_card_ok(F.lit(True), F.lit(None).cast("boolean"))) is True
    assert one(spark, rules.plural(F.lit(1), "{{ count }} film", "{{ count }} films")) == "1 film"
    assert one(spark, rules.duties_text(F.lit(True), F.lit(True), F.lit(False), F.lit(False))) == "duties_and_taxes_included_shipping"
    assert one(spark, rules.optimistic_count(F.lit(3), F.lit(2), F.lit(False))) == 2


def test_requests():
    request = CatalogRequest(filters={"b": ("y", "x", "x"), "a": ()}, price_lte=900, q=" q ", sort="odd", page=0)
    own = request.normalized(range_max=500)
    assert own == CatalogRequest(filters={"b": ("x", "y")}, price_lte=500, q="q", sort="manual", page=1)
    assert request.key() == CatalogRequest(filters={"b": ("x", "y")}, price_lte=900, q="q").key()
    assert request.toggled("b", "x").filters["b"] == ("y",)
    assert request.toggled("b", "z").page == 1
    assert request.is_filtered and not request.cleared().is_filtered
    assert catalog.page_links(5, 9) == [1, None, 4, 5, 6, None, 9]


def test_range_summary(spark):
    low, high = range_summary(F.lit(None).cast("long"), F.lit(None).cast("long"), F.lit(99).cast("long"))
    assert (one(spark, low), one(spark, high)) == (0, 99)


def test_set_edits(spark):
    a = F.array(F.lit("a"), F.lit("b"), F.lit("a"))
    assert one(spark, lookups.remove_first(a, F.lit("a"))) == ["b", "a"]
    assert one(spark, lookups.remove_first(a, F.lit("z"))) == ["a", "b", "a"]
    assert one(spark, lookups.add_if_absent(a, F.lit("a"))) == ["a", "b", "a"]
    assert one(spark, lookups.set_equal(F.array(F.lit("a")), F.array(F.lit("b")))) is False


def test_nearest_keeps_the_earliest(spark):
    assert one(spark, curation.nearest(F.array(F.lit(4), F.lit(6)), F.lit(5))) == 4


def test_keyed_writes(spark):
    lines = spark.createDataFrame([(1, 2), (2, 5)], "id long, quantity int")
    changes = spark.createDataFrame([(1, 9, 1), (1, 7, 2), (2, 0, 1), (3, 4, 1)], "id long, quantity int, at int")
    assert sorted(upsert(lines, changes, ["id"], order="at").collect()) == [(1, 7), (3, 4)]
    updates = F.create_map(F.lit("1"), F.lit(0), F.lit("5"), F.lit(3))
    assert sorted(upsert_map(lines, updates, "id").collect()) == [(2, 5), (5, 3)]


def test_store_and_json(spark):
    entries = spark.createDataFrame([("a", 1000), ("b", 500)], "k string, timestamp long")
    assert [r.k for r in alive(entries, 10_600).collect()] == ["a"]
    rows = spark.createDataFrame([('{"x": 1}',), ("no",)], "j string")
    assert [r.j and r.j.x for r in from_json(rows, "j", "x int").collect()] == [1, None]


def test_members(spark):
    rows = spark.createDataFrame([(["active-subscription"], dt.date(1990, 2, 3)), (["renter"], dt.date(1991, 2, 3))], "tags array<string>, birthday date")
    assert curation.members_with_birthday(rows, F.lit(dt.date(2024, 2, 3))).count() == 1
    prices = rows.select(curation.member_price(F.lit(105).cast("long"), F.col("tags")).alias("p"))
    assert sorted(r.p for r in prices.collect()) == [95, 105]
    assert curation.recommendation_fallback(rows, "birthday", dt.date(1990, 2, 3), "complementary", 3).count() == 0


def test_cascade_is_one_level(spark):
    lines = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b"), ("d", "a"), ("e", None)], "key string, parent string")
    gone = spark.createDataFrame([("a",)], "key string")
    assert sorted(r.key for r in lookups.cascade(lines, gone, "key", "parent").collect()) == ["a", "b", "d"]


def test_array_filters(spark):
    rows = F.array(*(F.struct(F.lit(k).alias("k"), F.lit(v).cast("int").alias("v")) for k, v in (("a", 1), ("b", None), ("a", 3))))
    assert [r.v for r in one(spark, arrays.where(rows, "k", F.lit("a")))] == [1, 3]
    assert [r.k for r in one(spark, arrays.reject(rows, "v", F.lit(1)))] == ["b", "a"]
    assert one(spark, arrays.find_index(rows, "k", F.lit("b"))) == 1
    assert one(spark, arrays.find_index(rows, "k", F.lit("z"))) is None
    assert one(spark, arrays.find(rows, "k", F.lit("z"))) is None
    assert one(spark, arrays.total(rows, "v")) == 4
    assert one(spark, arrays.pluck(rows, "v")) == [1, None, 3]
    assert one(spark, arrays.sort_natural(F.array(*map(F.lit, ("b", "A", "a", "C"))))) == ["A", "a", "b", "C"]
    assert [(r.value, r.next) for r in one(spark, arrays.lookahead(F.array(F.lit(1), F.lit(5))))] == [(1, 5), (5, None)]


def test_template_functions(spark):
    assert one(spark, template.to_int_or(F.lit("12px"), F.lit(0))) == 12
    assert one(spark, template.to_int_or(F.lit("x"), F.lit(7))) == 7
    assert one(spark, template.to_int_or(F.lit(None).cast("string"), F.lit(7))) == 7
    assert one(spark, template.modulo(F.lit(-3), 7)) == 4
    assert one(spark, template.divided_by(F.lit(-3), 2)) == -2
    assert one(spark, template.without_trailing_zeros(F.lit("12.00"))) == "12"
    assert one(spark, template.without_trailing_zeros(F.lit("12.50"))) == "12.50"
    assert one(spark, template.unit_price(F.lit("$1"), F.lit("g"), F.lit(500))) == "$1/500g"
    assert one(spark, template.format_date(F.lit(dt.date(2024, 3, 5)), "on %B %e, %Y")) == "on March 5, 2024"
    assert one(spark, template.translate({"a.one": "{{ count }} x", "a.other": "{{ count }} xs"}, F.lit("a"), F.lit(3))) == "3 xs"
    assert one(spark, template.translate({"a": "b"}, F.lit("missing"))) == "missing"


def test_prices_of_conditions_shuffle_no_copies(spark):
    copies = spark.createDataFrame([(1, "A", "Available"), (2, "N", "Sold"), (3, "N", "Available"), (4, "X", "Available")], "id long, condition string, status string")
    prices = spark.createDataFrame([("A", 100), ("N", 60)], "condition string, percent int")
    found = curation.condition_prices(copies, prices, "condition")
    assert sorted((r.id, r.percent) for r in found.collect()) == [(1, 100), (3, 60)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning(condition" not in plan


def test_tasks_of_a_shuffle_are_as_asked(spark):
    shuffled = spark.range(100).groupBy((F.col("id") * 7).alias("n")).count().withColumn("task", F.spark_partition_id())
    assert stored_in(shuffled, "tasks", 37).select("task").distinct().count() > 30
    assert stored_in(shuffled, "tasks", 1).select("task").distinct().count() == 1
