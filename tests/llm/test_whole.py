"""Results that were once cut short."""

from __future__ import annotations

import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import _session, _text, decontaminate, jaccard, langmodel, licenses, mixing, quality, secrets

DOCS = "doc_id long, text string"


def test_texts_shorter_than_an_item(spark):
    """Items less some words at their ends, and edited ones, as whole texts."""
    rng = random.Random(7)
    items = [(i, " ".join(f"b{rng.randrange(900)}" for _ in range(rng.randrange(3, 60)))) for i in range(20)]
    docs = []
    for i, text in items:
        words = text.split()
        for cut in range(6):
            docs += [(len(docs), " ".join(words[cut:])), (len(docs) + 1, " ".join(words[: len(words) - cut]))]
        docs.append((len(docs), " ".join([*words[: len(words) // 2], "changed", *words[len(words) // 2 + 2 :]])))
    bag = lambda ws, k: Counter(tuple(ws[j : j + k]) for j in range(len(ws) - k + 1))
    want = {}
    for d, text in docs:
        words = text.split()
        for i, item in items:
            own = item.split()
            k, size = min(5, len(own)), min(len(words), len(own))
            for a in range(len(words) - size + 1):
                x, y = bag(words[a : a + size], k), bag(own, k)
                value = sum((x & y).values()) / max(1, sum((x | y).values()))
                if value >= 0.8 and value > want.get((d, i), (0,))[0]:
                    want[d, i] = (value, a, size)
    table, bench = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id): (r.similarity, r.start_word, r.n_words) for r in decontaminate.find_matches(table, bench).collect()}
    assert any(size < len(items[i][1].split()) for (_, i), (_, _, size) in want.items())
    assert found.keys() == want.keys()
    assert all(abs(found[x][0] - want[x][0]) < 1e-12 and found[x][1:] == want[x][1:] for x in want)
    assert {r.doc_id for r in decontaminate.drop_contaminated(table, bench).collect()} == {d for d, _ in docs} - {d for d, _ in want}


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal"""
BSD = """ * Redistribution and use in source and binary forms, with or without
 * modification, are permitted provided that the following conditions are met:"""
MPL = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this file */"""


def test_wrapped_notices(spark):
    long = " ".join(["filler words of prose"] * 20_000)
    texts = [MIT, BSD, MPL, f"{long}\n{MIT}", "Permission is hereby\n" + "other words\n" * 40 + "granted, free of charge, to any person obtaining a copy", long]
    docs = [(i, t) for i, t in enumerate(texts)] + [(10, "Redistribution and use in source and binary forms, with"), (11, "or without modification, are permitted")]
    found = {r.doc_id: r.labels for r in licenses.scan_licenses(spark.createDataFrame(docs, DOCS).coalesce(1)).collect()}
    assert found == {0: "mit", 1: "bsd", 2: "mpl-2", 3: "mit", 4: "", 5: "", 10: "", 11: ""}
    assert found.keys() == {d for d, _ in docs}


def test_short_and_scattered_notices(spark):
    scattered = "the mit group released a report. students under pressure need a license to drive"
    texts = ["Released under MIT License", "Apache License 2.0", "MIT License", scattered, "(Apache License, version\n# 2.0)", "the Apache tribe has a 2 year license and 0 debts", "license. MIT", "licensed under the GNU Lesser\n * General Public License version 3"]
    found = {r.doc_id: r.labels for r in licenses.scan_licenses(spark.createDataFrame(list(enumerate(texts)), DOCS)).collect()}
    assert found == {0: "mit", 1: "apache-2", 2: "mit", 3: "", 4: "apache-2", 5: "", 6: "mit", 7: "gpl-3,lgpl-3"}


def test_secrets_in_assignments_and_paths(spark):
    rng = random.Random(9)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    forms = ("AWS_SECRET_ACCESS_KEY={}", "sig={}==", "SESSION={};", "https://host.example/some-path/{}", "x_y/{}", "see {} there")
    keys = ["".join(rng.choices(letters, k=40)) for _ in range(120)]
    docs = [(i, forms[i % len(forms)].format(key)) for i, key in enumerate(keys)]
    table = spark.createDataFrame(docs, DOCS)
    left = {r.doc_id: r.text for r in secrets.redact_secrets(table).collect()}
    for i in range(len(forms)):
        assert sum(keys[d] not in left[d] for d in range(i, len(keys), len(forms))) >= 16, forms[i]
    for r in secrets.find_secrets(table).collect():
        for _, a, b in (s.split(":") for s in filter(None, r.spans.split(","))):
            assert 0 <= int(a) < int(b) <= len(docs[r.doc_id][1])


def test_rest_of_a_secret_beside_a_base_match(spark):
    rng = random.Random(10)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    key = lambda n: "".join(rng.choices(letters, k=n))
    docs = [(i, "".join((key(40), "Z", "".join(rng.choices("0123456789abcdef", k=16)), "Z", key(40)))) for i in range(40)]
    left = [r.text for r in secrets.redact_secrets(spark.createDataFrame(docs, DOCS), "*").collect()]
    assert sum(set(t) == {"*"} for t in left) >= 32


def test_one_row_of_each_component_stays(spark):
    words = lambda seed: " ".join(f"w{random.Random(seed).randrange(10**6)}x{i}" for i in range(40))
    a, b, c, d = (words(i) for i in range(4))
    rows = [(1, a, "p"), (5, a, "q"), (5, b, "r"), (None, a, "s"), (None, c, "t"), (None, c, "u"), (None, c + " more", "v"), (7, d, "w"), (None, d, "x"), (7, d, "y"), (8, "", "z"), (9, " ", "z"), (None, None, "z"), (None, None, "z")]
    kept = jaccard.drop_near_copies(spark.createDataFrame(rows, DOCS + ", h string")).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, (r.text or "").removesuffix(" more")) for r in kept) == sorted(
        [(False, 1, a), (False, 5, b), (True, 0, c), (False, 7, d), (False, 8, ""), (False, 9, " "), (True, 0, "")]
    )


def test_leaves_without_a_listed_name_get_budget(spark):
    rows = [(i, "w", lang, source) for i, (lang, source) in enumerate([("en", "src0"), ("it", "src0"), (None, "src1"), ("de", "wiki"), ("en", None)] * 400)]
    found = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), percent=100).collect()
    assert {(r.lang, r.source) for r in found} == {(lang, source) for _, _, lang, source in rows}


def test_matches_do_not_follow_the_size_of_parts(spark):
    """Ids that repeat, with other texts or without an id, over one part and over many."""
    rng = random.Random(11)
    texts = [" ".join(f"p{rng.randrange(5000)}" for _ in range(rng.randrange(8, 30))) for _ in range(24)]
    items = [(i % 5 if i % 7 else None, t) for i, t in enumerate(texts)]
    docs = [(d, " ".join(["before", *rng.sample(texts, 4), "after"])) for d in range(30)]
    table, bench = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string")
    found = [sorted(map(repr, decontaminate.find_matches(table, bench, size).collect())) for size in (1 << 25, 2000, 500)]
    assert len(found[0]) > 50 and all(f == found[0] for f in found)
    assert len({(r.doc_id, r.item_id) for r in decontaminate.find_matches(table, bench, 2000).collect()}) == len(found[0])


def test_survivor_does_not_follow_the_order_of_rows(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(i % 3, text if i % 2 else text + " more", lang, i % 4) for i in range(24) for lang in ("en", "de", None)]
    rows += [(None, "other words of a text that stands alone here", lang, None) for lang in ("fr", "it")]
    kept = []
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, x int").withColumn("m", F.create_map(F.lit("a"), F.lit(1)))
        kept.append(sorted(map(repr, jaccard.drop_near_copies(frame.repartition(1 + 2 * seed)).collect())))
    assert len(kept[0]) == 2 and kept[0] == kept[1] == kept[2]


def test_dropping_near_copies_counts_no_links(spark, monkeypatch):
    """The quadratic count of a component's links is for those who ask for it."""
    monkeypatch.setattr(jaccard, "count_links", None)
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(3, text, "en", "a", 0), (1, text + " more", "en", "a", 0), (2, "another text of some words that stands alone", "en", "a", 0)]
    kept = jaccard.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2]


def test_hashing_many_texts_holds_little(spark):
    """Memory beyond the texts themselves, of which there are 6 MB; workers keep what they once took."""
    texts = [" ".join(f"w{(i * j) % 977}" for j in range(500)) for i in range(2500)]
    for use in (lambda: quality.features(texts), lambda: sum(len(s) for s in _text.shingle_sets(texts, 5, _text.NOT_WHITE))):
        _text._powers.clear()
        tracemalloc.start()
        use()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 40 << 20, peak


def test_batches_are_met_in_few_rows(spark):
    """Texts become strings of Python some rows at a time; every row is met once and in order."""
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(2500)), "text": [f"text {i}" for i in range(2500)]})
    parts = list(_text.few_rows([batch, batch.slice(0, 0), batch.slice(7, 3)]))
    assert [p.num_rows for p in parts] == [1000, 1000, 500, 3]
    assert [i for p in parts for i in p.column(0).to_pylist()] == [*range(2500), 7, 8, 9]


def test_stages_of_batches_of_many_rows(spark):
    """Rows at both ends of what is met at once: the same as one by one."""
    item = " ".join(f"b{i}" for i in range(30))
    rows = [(i, f"before {item} after" if i in (0, 999, 1000, 1001, 2599) else f"own words {i} of text {i * 7} in row {i * 13}") for i in range(2600)]
    table, bench = spark.createDataFrame(rows, DOCS).coalesce(1), spark.createDataFrame([(1, item)], "item_id long, text string")
    assert sorted(r.doc_id for r in decontaminate.find_matches(table, bench).collect()) == [0, 999, 1000, 1001, 2599]
    assert sorted(r.doc_id for r in decontaminate.drop_contaminated(table, bench).collect()) == sorted({i for i, _ in rows} - {0, 999, 1000, 1001, 2599})
    found = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in jaccard.jaccard_components(table).collect()}
    assert len(found) == 2600 and {i for i, x in found.items() if x[1] != i} == {999, 1000, 1001, 2599} and found[0][2] == 0


def test_redaction_writes_texts_once(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(secrets, "written", lambda df, name: seen.append(df.columns) or _session.written(df, name))
    docs = spark.createDataFrame([(1, "token = abcdefghijklmnop0123 here", 32), (2, None, 0)], DOCS + ", n_chars long")
    left = {r.doc_id: (r.text, r.n_chars) for r in secrets.redact_secrets(docs).collect()}
    assert left == {1: ("[SECRET] here", 13), 2: (None, 0)}  # n_chars counts what stands after the last secret, too
    assert seen == [["_row", "_base", "_runs"]]


class Taken:
    """Stands for a DataFrame and keeps what tasks would run."""

    def mapInArrow(self, run, schema):
        self.run = run
        return self

    def __getattr__(self, name):
        return lambda *_: self


def test_language_model_holds_little(spark):
    """What a task holds beyond its batch (of 25 MB of texts, here) and what it gives back at once; workers keep what they once took."""
    word = lambda i, j: f"w{(i * j) % 9973}" if j % 3 else f"own{i * 300 + j}"
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(8000)), "held_out": [False] * 8000, "text": [" ".join(word(i, j) for j in range(400)) for i in range(8000)]})
    lexicon = langmodel.Lexicon(np.arange(1000, dtype=np.uint64), np.full(1000, 5), 4_000_000, 1_100_000)
    counted, encoded, seen = Taken(), Taken(), Taken()
    langmodel.vocabulary(counted)
    langmodel.encode(encoded, lexicon)
    langmodel.history_counts(seen, lexicon.size)
    given = pa.Table.from_batches(list(encoded.run([batch]))).select(["classes", "features"]).combine_chunks().to_batches()
    for tasks, batches in ((counted, [batch.select(["text"])]), (encoded, [batch]), (seen, given)):
        _text._powers.clear()
        tracemalloc.start()
        largest = max(x.nbytes for x in tasks.run(batches))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert largest < 8 << 20 and peak < 48 << 20, (largest, peak)


@pytest.mark.parametrize("held", [1, 8, 1 << 18])
def test_language_model_counts_whole(monkeypatch, held):
    """However few keys a task holds, no count is lost."""
    monkeypatch.setattr(langmodel, "HELD", held)
    rng = random.Random(3)
    keys = [[rng.randrange(40) - 20 for _ in range(rng.randrange(1, 30))] for _ in range(50)]
    found, most = Counter(), 0
    for x in langmodel.tallied((np.unique(np.array(k), return_counts=True) for k in keys), ["word", "c"]):
        most = max(most, x.num_rows)
        found.update(dict(zip(x.column(0).to_pylist(), x.column(1).to_pylist(), strict=True)))
    assert found == Counter(k for some in keys for k in some) and most <= min(40, 2 * held + 30)
    assert not list(langmodel.tallied(iter(()), ["word", "c"]))


@pytest.mark.parametrize("size", [1 << 16, 1 << 17])
def test_language_model_rows_are_held_whole(size):
    """The last row, which stands before a text's first word, and those around 65,536 come back from the encoded texts."""
    rows = np.array([0, size - 1, 65_535, min(65_536, size - 1)])
    batch = pa.RecordBatch.from_pydict({"classes": [b"\x00\x01", b"", b"\x02" * 4], "features": [rows[:2].astype(langmodel.row_type(size)).tobytes(), b"", rows.astype(langmodel.row_type(size)).tobytes()]})
    found = list(langmodel._gathered(batch.slice(1), size))
    assert len(found) == 1
    text, kinds, column, before = found[0]
    assert text.tolist() == [1] * 4 and kinds.tolist() == [2] * 4 and column.tolist() == langmodel.columns(rows).tolist()
    assert before.tolist() == [one * size + two for one, two in zip([size - 1, *rows[:3]], [size - 1, size - 1, *rows[:2]], strict=True)]
