"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from shelfmark.llm import decontaminate, jaccard, langmodel, licenses, mixing, neighbours, quality, secrets, toxicity, warc
from shelfmark.llm._session import new_folder

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"
LONG = "word and another one of them\n" * 20_000


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (1, "plain words of a clean text that has some length to it", "en", "src1", 10), (1, "plain words of a clean text that has some length to it", "en", "src1", 10),
        (2, None, None, None, None), (3, "", "en", "src2", 0), (None, "no id here token=abcdefghijklmnop1", "en", "src3", 5), (None, None, None, None, None),
        (4, LONG, "de", "src4", len(LONG)), (5, "you are an idiot. Released under the MIT License", "en", "src0", 7), (6, "  \n\t ", "en", "src0", 6), (7, "😀 é ü", "fr", "srcx", 5),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def clashing(docs):
    """The same with columns named like those that operators add."""
    names = ("score", "labels", "n_words", "held_out", "h", "node", "comp", "n", "row", "word", "_spans", "_base", "_runs", "_text", "domain", "n_tokens", "epochs", "x")
    return docs.select("*", *(F.lit("mine").alias(c) for c in names))


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (5, 0, 1), (4, 0, 0), (4, 1, 0), (None, 1, 1), (2, None, None), (7, 1, 0), (99, 1, 1)], LABELS)


def operators(labels, items):
    return {
        "decontaminate": lambda d: decontaminate.find_matches(d, items),
        "drop_contaminated": lambda d: decontaminate.drop_contaminated(d, items),
        "licenses": licenses.scan_licenses,
        "toxicity": lambda d: toxicity.score_toxicity(d, toxicity.train(d, labels)),
        "mixing": mixing.mix,
        "jaccard": jaccard.jaccard_components,
        "drop_near_copies": jaccard.drop_near_copies,
        "secrets": secrets.find_secrets,
        "redact": secrets.redact_secrets,
        "language model": langmodel.score_texts,
        "quality": lambda d: quality.score_quality(d, quality.train(d, labels)),
        "keep_good": lambda d: quality.keep_good(d, quality.train(d, labels)),
    }


NAMES = sorted(operators(None, None))
PER_ROW = {"licenses", "toxicity", "jaccard", "secrets", "redact", "language model", "quality"}


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, "words of a clean text that has some length"), (2, None), (3, ""), (None, "no id"), (4, "..."), (1, "words of a clean text that has some length")], "item_id long, text string")


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows_and_clashing_columns(name, docs, clashing, labels, items):
    run = operators(labels, items)[name]
    found, more = run(docs).collect(), run(clashing).collect()
    assert len(found) == len(more)
    if name in PER_ROW:
        assert len(found) == docs.count()


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables(name, docs, labels, items, spark):
    none = docs.limit(0)
    assert operators(labels, items)[name](none).count() == 0
    operators(labels.limit(0), items.limit(0))[name](docs).collect()


def test_filters_keep_columns(docs, labels, items):
    for name in ("drop_contaminated", "drop_near_copies", "redact", "keep_good"):
        assert operators(labels, items)[name](docs).columns == docs.columns


def test_matches_of_repeated_items_and_rows(docs, items):
    found = decontaminate.find_matches(docs, items).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.item_id or 0, r.similarity) for r in found) == [(False, 1, 1, 1.0), (False, 1, 1, 1.0), (True, 0, 0, 1.0)]
    assert {r.start_word for r in found if r.doc_id == 1} == {1}


def test_components_of_odd_rows(docs):
    found = {(r.doc_id, r.n_shingles): r.component_id for r in jaccard.jaccard_components(docs).collect()}
    assert found[2, 0] == 2 and found[3, 0] == 3 and found[6, 0] == 6 and found[None, 0] is None
    assert found[1, 8] == 1


def test_mixture_takes_whole_leaves(docs):
    found = mixing.mix(docs, percent=100, epochs=1, weights=(None, None, None)).collect()
    assert sum(r.n_tokens * r.epochs for r in found) == sum(r.n_tokens for r in mixing.mix(docs, 1000, 1, weights=(None, None, None)).collect())


def test_redaction(docs):
    found = {r.doc_id: r for r in secrets.redact_secrets(docs).collect() if r.text}
    assert found[None].text == "no id here [SECRET]" and found[None].n_chars == 19
    assert found[4].text == LONG and found[4].n_chars == len(LONG)


def test_unlabelled_models_are_defined(docs, labels):
    none = labels.limit(0)
    assert {r.score for r in quality.score_quality(docs, quality.train(docs, none)).collect()} == {0.5}
    scores = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, toxicity.train(docs, none)).collect()}
    assert scores[5] > scores[1]


def test_vectors_that_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (100, [0.0, 1.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [1.0, None]), (7, [1.0]), (None, [1.0, 1.0]), (2, [1.0, 0.0]), (8, [])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = neighbours.search(vectors, vectors.filter("vec_id % 100 = 0"), k=2).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in found] == [(0, 1, 1), (0, 2, 2), (100, 1, 0), (100, 2, 1)]
    assert found[0].score == 0.0 and abs(found[2].score - 2**0.5) < 1e-15
    assert neighbours.search(vectors.limit(0), vectors).count() == 0
    assert neighbours.search(vectors, vectors.filter("vec_id = 100")).count() == 3


def test_neighbours_do_not_follow_the_order_of_rows(spark):
    """Ties of the footrule, several blocks, and columns named like those of the index."""
    rng = random.Random(4)
    rows = [(i, [float(rng.randrange(3)) for _ in range(4)] + [1.0]) for i in range(600)]
    found = []
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({c: F.lit("mine") for c in ("n", "v", "ids", "vb", "qb", "d", "x", "score", "rank")})
        found.append(neighbours.search(vectors.repartition(1 + 3 * seed), vectors.filter("vec_id % 100 = 0"), k=5, pivots=20, nearest=6, reads=4, rerank=0.5, block=40).collect())
    assert sorted(found[0]) == sorted(found[1]) == sorted(found[2]) and len(found[0]) == 30


def test_ids_that_repeat_with_other_texts(spark, labels):
    """Which text is fitted on doesn't follow the order of rows, and all are scored."""
    rng = random.Random(5)
    rows = [(i % 40, " ".join(rng.choice(["good", "words", "idiot", "!!!", "text"]) for _ in range(12))) for i in range(160)]
    marks = spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(40)], LABELS)
    found = []
    for seed in range(2):
        random.Random(seed).shuffle(rows)
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(1 + 4 * seed)
        a = toxicity.score_toxicity(docs, toxicity.train(docs, marks)).collect()
        b = quality.score_quality(docs, quality.train(docs, marks)).collect()
        found.append([sorted((r.doc_id, round(r.score, 9)) for r in x) for x in (a, b)])
    assert found[0] == found[1] and all(len(x) == 160 for x in found[0])


def test_a_very_long_payload(spark):
    rows = [(1, "u", "é" * 3_000_000), (2, "u", "é" * 3_000_000), (3, "u", "x" * 99)]
    folder = new_folder(spark, "warc")
    found = warc.read_archives(warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), folder), folder).collect()
    assert sorted((r.page_id, r.record_type, r.refers_to, r.payload_bytes, len(r.payload or b"")) for r in found) == [
        (1, "response", None, 6_000_000, 6_000_000), (2, "revisit", 1, 6_000_000, 0), (3, "response", None, 99, 99),
    ]


def test_pages_that_repeat(spark):
    same, short = "x" * 200, "y" * 99
    rows = [(3, "c", same), (1, "a", same), (1, "a", same), (5, None, None), (6, "f", ""), (7, "g", short), (8, "h", short), (None, "n", "z" * 150), (None, "m", "z" * 150), (9, "a\r\nb", "é" * 60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload_digest", F.lit("mine"))
    folder = new_folder(spark, "warc")
    found = warc.read_archives(warc.write_archives(pages, folder), folder).collect()
    kinds = sorted((r.page_id is None, r.page_id or 0, r.record_type, r.refers_to or 0, r.payload_bytes) for r in found)
    assert kinds == [
        (False, 1, "response", 0, 200), (False, 1, "revisit", 1, 200), (False, 3, "revisit", 1, 200), (False, 5, "response", 0, 0), (False, 6, "response", 0, 0), (False, 7, "response", 0, 99),
        (False, 8, "response", 0, 99), (False, 9, "response", 0, 120), (True, 0, "response", 0, 150), (True, 0, "revisit", 0, 150),
    ]
    assert {r.payload.decode() for r in found if r.page_id == 9} == {"é" * 60}
    assert warc.read_archives(warc.write_archives(pages.limit(0), folder), folder).count() == 0
