"""Stored indexes and tables, paths into JSON, and cursors."""

from __future__ import annotations

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from shelfmark.functions import paths, text
from shelfmark.operators import bitmaps, catalog, search_index
from shelfmark.plans.request import CatalogRequest, Facets, range_text
from shelfmark.sources import carts
from tests.compare import spark_rows

TITLES = ["The Blu-ray of Spider-Man", "blu ray", "Bluray", "ray of light: the film", "Straße 中文 état", "état d'âme", "the THE the", "", None, "9 to 5", "über_unter"]


def films(spark):
    rows = [(i, t, f"format {i % 3}", i % 2 == 0, 100 * i) for i, t in enumerate(TITLES * 3)]
    return spark.createDataFrame(rows, "id long, title string, format string, used boolean, price long")


FACETS = Facets(lists=("format", "used"), price="price", title="title", key="id", booleans=("used",))


def test_queries_with_punctuation(spark):
    found = lambda q: {r.title for r in films(spark).filter(text.all_terms_match(F.col("title"), q)).collect()}
    assert found("blu-ray") == {"The Blu-ray of Spider-Man", "blu ray"} == found("blu ray")
    assert found("Spider-Man!") == {"The Blu-ray of Spider-Man"} and found("unter") == {"über_unter"}
    assert found("--") == set() and len(found(" ")) == len(set(TITLES))


@pytest.mark.parametrize("query", ["blu-ray", "the", "the ray", "ray the", "é", "état", "中", "5", "9 t", "nothing", "the the", "--", "ra"])
def test_index_finds_what_the_scan_finds(spark, tmp_path_factory, query, index):
    want = {r.id for r in films(spark).filter(text.all_terms_match(F.col("title"), query)).collect()}
    found = [r.id for r in search_index.search(spark, index, query).collect()]
    assert len(found) == len(set(found)) and set(found) == want


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("terms") / "index")
    search_index.build(films(spark), "id", "title", path)
    return path


def test_a_search_reads_its_terms_files(spark, index):
    plan = search_index.search(spark, index, "the blu")._jdf.queryExecution().executedPlan().toString()
    scans = [x.split("PushedFilters")[0] for x in plan.split("PartitionFilters:")[1:]]
    assert len(scans) == 2 and sorted("head" in x and next(h for h in "tb" if f"= {h})" in x) for x in scans) == ["b", "t"]
    assert "StringStartsWith(term,blu)" in plan and "EqualTo(term,the)" in plan


def test_beginnings_of_words(spark, tmp_path):
    pages = spark.createDataFrame([(1, "blue bird"), (2, "blue bird"), (3, "a bluff"), (4, "none")], "id long, url string")
    resources = {"film": (films(spark), "id", "title"), "page": (pages, "id", "url")}
    search_index.build_beginnings(resources, str(tmp_path), longest=3, most=4)
    for query in ("b", "bl", " BLU ", "é", "t", "x", "9"):
        want = spark_rows(catalog.predictive(resources, query, 4))
        assert spark_rows(search_index.suggested(spark, str(tmp_path), query, ["film", "page"], 4, longest=3)) == want
    assert search_index.suggested(spark, str(tmp_path), "blue", ["film"], 4, longest=3) is None
    assert search_index.suggested(spark, str(tmp_path), "b b", ["film"], 4, longest=3) is None
    plan = search_index.suggested(spark, str(tmp_path), "bl", ["film"], 4, longest=3)._jdf.queryExecution().executedPlan().toString()
    assert "= b)" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0]


REQUESTS = [
    CatalogRequest(),
    CatalogRequest(filters={"format": ("format 1",)}),
    CatalogRequest(filters={"format": ("format 1", "format 2"), "size": ("3",)}, price_gte=250),
    CatalogRequest(filters={"size": ("3", "4", "none")}, price_gte=1000, price_lte=1999),
    CatalogRequest(price_lte=1500),
    CatalogRequest(price_gte=1001, price_lte=1002),
    CatalogRequest(filters={"format": ("none",)}),
]


def test_counts_from_bitmaps(spark, tmp_path):
    """One stored index, several requests; ids over several buckets."""
    rng = random.Random(2)
    rows = [(rng.randrange(1, 200_000), rng.choice(["format 0", "format 1", "format 2"]), rng.randrange(6), rng.randrange(3000)) for _ in range(3000)]
    rows = list({r[0]: r for r in rows}.values())
    facets = Facets(lists=("format", "size"), price="price", title="format", key="id")
    products = spark.createDataFrame(rows, "id long, format string, size int, price long").cache()
    bitmaps.build(products, facets, str(tmp_path / "index"), band=500)
    for request in REQUESTS:
        assert spark_rows(bitmaps.facet_counts(spark, str(tmp_path / "index"), 500, request, facets)) == spark_rows(catalog.facet_counts(products, request, facets)), request


def test_cart_table_rewrites_what_changed(spark, tmp_path):
    rng = random.Random(3)
    held = {(c, v): rng.randrange(1, 9) for c in range(60) for v in rng.sample(range(20), 3)}
    table = carts.CartTable(spark, str(tmp_path / "carts"), buckets=8)
    table.create(spark.createDataFrame([(c, v, q) for (c, v), q in held.items()], table.schema))
    files = lambda: {os.path.join(d, f) for d, _, names in os.walk(tmp_path / "carts") for f in names if f.endswith(".parquet")}
    lines = lambda: sorted((r.cart_id, r.variant_id, r.quantity) for r in table.lines().collect())
    before = files()
    changes = spark.createDataFrame([(5, 100, 3, 1), (5, 100, 4, 2), (5, 101, 0, 1), (None, 1, 1, 1)], "cart_id long, variant_id long, quantity long, at int")
    [bucket] = table.set(changes)
    held[5, 100] = 4
    assert lines() == sorted((c, v, q) for (c, v), q in held.items())
    kept = {f for f in before if f"bucket={bucket}/" not in f}
    assert kept < files() and not (before - kept) & files()
    after = files()
    assert table.set(changes) == [] and files() == after  # a repeated change writes nothing
    gone = spark.createDataFrame([(c, v, 0) for c, v in held], table.schema)
    assert len(table.set(gone)) == 8 and lines() == []
    table.add(spark.createDataFrame([(1, 1, 2), (1, 1, 3)], table.schema))
    table.add(spark.createDataFrame([(1, 1, 1)], table.schema))
    assert lines() == [(1, 1, 6)]


def test_carts_from_json(spark, tmp_path):
    docs = [
        json.dumps({"token": "a", "item_count": 3, "items": [{"variant_id": 1, "quantity": 1, "more": [1]}, {"variant_id": 2, "quantity": 2, "properties": {"_x": "y"}}], "unknown": {}}),
        '{"token": "b", "items": [{"variant_id": 3, "quan', json.dumps({"token": "c", "item_count": 5, "items": [{"variant_id": 4, "quantity": 1}]}),
        json.dumps({"token": "d", "items": []}), json.dumps({"token": "e", "item_count": "many", "items": []}), "", "[]", "null",
    ]
    spark.createDataFrame([(d,) for d in docs], "value string").coalesce(1).write.text(str(tmp_path / "carts"))
    read = carts.read_carts(spark, str(tmp_path / "carts"))
    assert sorted((r.token, r.line, r.variant_id, r.quantity) for r in carts.lines_of(read).collect()) == [("a", 1, 1, 1), ("a", 2, 2, 2), ("c", 1, 4, 1)]
    found = carts.quality(read).first()
    assert found.carts == 7 and found.broken >= 2 and found.mismatched == 1
    assert {r.corrupt for r in read.filter("corrupt is not null").collect()} >= {docs[1], docs[4]}


def test_paths(spark):
    doc = {"a": {"b": [10, {"c": "x"}], "1": "one", "k.x": 3}, "i": 1, "n": None, "t": True, "f": 0, "e": "", "s": "10", "o": {}, "big": 1.5}
    row = spark.createDataFrame([(json.dumps(doc),)], "j string").select(paths.parsed(F.col("j")).alias("v"))
    value = lambda path: row.select(paths.text(paths.at(F.col("v"), path))).first()[0]
    assert [value(p) for p in ("a.b[0]", "a.b.0", "a.b[i].c", "a['b'][1].c", "a.1", "i", "big", "s")] == ["10", "10", "x", "x", "one", "1", "1.5", "10"]
    assert [value(p) for p in ("a.b[2]", "a.x.y", "i.x", "n.x", "n", "a b", "", "a.b[", "a..b", "a.b[x]", "[0]")] == [None] * 11
    of = lambda path: paths.at(F.col("v"), path)
    check = lambda c: row.select(c).first()[0]
    assert [check(paths.same(of(a), paths.literal(b))) for a, b in (("s", 10), ("i", "1"), ("t", 1), ("n", None), ("zz", None), ("s", "10.0"), ("o", "{}"), ("f", None), ("e", ""))] == [
        True, True, True, True, True, False, False, False, True,
    ]
    assert [check(paths.identical(of(a), paths.literal(b))) for a, b in (("s", 10), ("i", 1), ("n", None), ("zz", None), ("t", 1))] == [False, True, True, False, False]
    assert [check(paths.truthy(of(p))) for p in ("a", "o", "t", "i", "s", "f", "e", "n", "zz")] == [True] * 5 + [False] * 4
    assert [check(paths.kind(of(p))) for p in ("a", "a.b", "i", "big", "s", "t", "n", "zz")] == ["object", "array", "number", "number", "string", "boolean", "null", "undefined"]
    assert spark.createDataFrame([("{",), (None,)], "j string").select(paths.text(paths.at(paths.parsed(F.col("j")), "a"))).collect() == [(None,), (None,)]


@pytest.mark.parametrize("sort", ["title-ascending", "title-descending", "price-descending", "manual"])
def test_pages_forth_and_back(spark, sort):
    rows = films(spark).filter("title is not null")
    own = CatalogRequest(filters={"used": ("true", "false")}, price_gte=200, sort=sort, page_size=4)
    pages, cursor = [], None
    while page := catalog.cursor_page(rows, own, FACETS, cursor).collect():
        pages.append(page)
        before, cursor = catalog.cursors(page, own, FACETS)
    assert sum(map(len, pages)) == rows.filter("price >= 200").count() and len({r.id for p in pages for r in p}) == sum(map(len, pages))
    back, (before, _) = [], catalog.cursors(pages[-1], own, FACETS)
    while page := catalog.cursor_page(rows, own, FACETS, catalog.Cursor.of(before.text())).collect():
        back.append(page)
        before, _ = catalog.cursors(page, own, FACETS)
    assert back[::-1] == pages[:-1]
    with pytest.raises(ValueError, match="another request"):
        catalog.cursor_page(rows, own.with_filters(format=("format 1",)), FACETS, before)


def test_boolean_facets_and_bounds_reach_the_scan(spark, tmp_path):
    films(spark).write.parquet(str(tmp_path / "films"))
    rows = spark.read.parquet(str(tmp_path / "films"))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString().split("PushedFilters:")[1]
    own = CatalogRequest(filters={"used": ("true",)}, sort="price-descending")
    assert "EqualTo(used,true)" in plan(catalog.filtered(rows, own, FACETS)) or "used" in plan(catalog.filtered(rows, own, FACETS)).split("]")[0]
    assert catalog.filtered(rows, own, FACETS).count() == rows.filter("used").count()
    assert catalog.filtered(rows, CatalogRequest(filters={"used": ("maybe",)}), FACETS).count() == 0
    back = catalog.cursor_page(rows, own, FACETS, catalog.Cursor(own.normalized().key(), (500, 5), False))
    assert "GreaterThanOrEqual(price,500)" in plan(back)


def test_values_shown_of_swatches_and_images(spark):
    counts = spark.createDataFrame([(f, f"v{i:02}", 100 - i) for f, n in (("swatch", 30), ("image", 8), ("list", 12), ("short", 11)) for i in range(n)], "facet string, value string, n long")
    hidden = lambda **more: {r.facet: r["n"] for r in catalog.visible_values(counts, swatches=["swatch"], images=["image"], **more).groupBy("facet").agg(F.count_if("hidden").alias("n")).collect()}
    assert hidden() == {"swatch": 0, "image": 2, "list": 2, "short": 0}
    assert hidden(swatch_labels=True)["swatch"] == 8


def test_text_of_ranges(spark):
    rows = spark.createDataFrame([(None, None), (100, None), (None, 250000), (5, 10)], "a long, b long")
    shown = rows.select(range_text(F.col("a"), F.col("b"), F.lit(99999).cast("long"), "{{amount}}", F.lit("USD")).alias("x"))
    assert [r.x for r in shown.collect()] == ["", "1.00–999.99", "0.00–2,500.00", "0.05–0.10"]


def test_marks_of_any_letter_go(spark):
    row = spark.createDataFrame([("ÀÉ ǅ ở ΐ й ḝ ñ ñ ø",)], "t string").select(text.normalized(F.col("t"))).first()[0]
    assert row == "ae ǆ o ι и e n n ø"


def test_words_go_through_one_shuffle_unless_keys_come_again(spark, tmp_path, monkeypatch):
    made, own = [], type(spark.range(0)).distinct
    monkeypatch.setattr(type(spark.range(0)), "distinct", lambda rows: made.append(rows) or own(rows))
    once, twice = str(tmp_path / "once"), str(tmp_path / "twice")
    search_index.build(films(spark), "id", "title", once)
    assert made == []
    search_index.build(films(spark).unionByName(films(spark)), "id", "title", twice)
    assert len(made) == 1
    rows = lambda path: sorted(map(tuple, spark.read.schema(search_index.POSTINGS).parquet(path).collect()))
    assert rows(once) == rows(twice)


def test_sorted_titles_are_dealt_by_rows(spark, tmp_path):
    path = str(tmp_path)
    search_index.build_beginnings({"film": (films(spark), "id", "title")}, path, longest=2, most=4, rows_a_task=2)
    tasks = spark.read.parquet(f"{path}/titles").select((F.col("place") / 2**33).cast("int").alias("task")).distinct().count()
    assert tasks > spark.sparkContext.defaultParallelism
