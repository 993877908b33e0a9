"""The pipeline as a whole, and the SQL of operators, on rows with nulls, repeated ids, empty texts and clashing columns."""

from __future__ import annotations

import random

import duckdb
import pytest

import corpus_pipeline
from shelfmark.llm import mixing, queries
from tests.compare import duck_rows, spark_rows

WORDS = "river stone garden window table market winter summer paper letter bridge forest mountain valley village road house door light shadow morning evening music dance story" \
    " train station boat harbour island ocean field flower orchard kitchen bread butter cheese apple coffee doctor teacher school lesson picture colour silver golden gentle quiet".split()  # fmt: skip
DOCS = "doc_id long, text string, lang string, source string, n_chars long, node string, score string, _row string"
LABELS, ITEMS = "doc_id long, quality int, toxic int", "item_id long, text string"


def prose(seed, n=40):
    return " ".join(random.Random(seed).sample(WORDS, n))


def doc(doc_id, text, lang="en", source="src0"):
    return (doc_id, text, lang, source, len(text or ""), "mine", "mine", "mine")


def stored(spark, folder, docs, labels=(), items=()):
    for name, rows, schema in (("documents", docs, DOCS), ("labels", labels, LABELS), ("benchmark", items, ITEMS)):
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def picked(rows):
    return sorted((r.doc_id is None, r.doc_id or 0, r.text or "", r.lang or "", r.source or "", r.node, r.score, r["_row"], r.domain, r.n_tokens, r.epochs) for r in rows)


def test_pipeline_of_odd_rows(spark, tmp_path):
    """Without labels none is rejected, so what stays is known row by row; the mixture of that is what run() must return."""
    a, b, c, leak, item = prose(1), prose(2), prose(3), prose(4), prose(5, 16)
    secret = f"{prose(6)} token=abcdefghijklmnop1"
    long = " ".join(prose(900 + i) for i in range(3000))
    others = [doc(100 + i, prose(100 + i), lang, source) for i, (lang, source) in enumerate([("en", "src1"), ("de", "src2"), (None, "src3"), ("it", None), ("fr", "wiki")] * 6)]
    stay = [doc(1, a), doc(5, b), doc(None, c), doc(8, ""), doc(None, None, None, None), doc(21, secret), doc(30, long), *others]
    go = [doc(1, a), doc(5, f"{a} more"), doc(None, a), doc(None, c), doc(20, f"{leak} {item} {leak}")]
    folder = stored(spark, tmp_path, [*go, *stay], items=[(1, item), (2, None), (None, "")])
    kept = [doc(21, f"{prose(6)} [SECRET]") if r[0] == 21 else r for r in stay]
    found = corpus_pipeline.run(spark, folder)
    assert found.columns == [*(x.split()[0] for x in DOCS.split(", ")), "domain", "n_tokens", "epochs"]
    want = picked(mixing.mix(spark.createDataFrame(kept, DOCS)).collect())
    assert len(want) > 10
    assert picked(found.collect()) == want


def test_pipeline_of_empty_tables(spark, tmp_path):
    assert corpus_pipeline.run(spark, stored(spark, tmp_path / "none", [])).count() == 0
    assert corpus_pipeline.run(spark, stored(spark, tmp_path / "blank", [doc(None, None, None, None), doc(1, "", None, None)], labels=[(1, None, None)])).columns[-1] == "epochs"


@pytest.mark.parametrize("name", ["op2_license_scan", "op6_mix_sources", "op8_secrets"])
def test_odd_rows_as_sql(name, spark, tmp_path):
    rng = random.Random(12)
    key = lambda n: "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", k=n))
    texts = ["", None, " \n\t", prose(1), "This is under the MIT License. Apache License, Version 2.0", "CC BY-NC, cc by nc", "MIT\n// License", "Licensed\n * under the\n * Apache License,\n * Version 2.0", "free and\nunencumbered\n# software released\n# into the public domain", "MIT and other words, license", "É ü 😀 under the MIT license", f"password = '{key(24)}' and AKIA{key(20).upper()}", f"see {key(40)} and 0123456789abcdef0123", f"API_KEY: {key(12)}", f"😀 secret:{key(11)}"]
    names = [("en", "src0"), ("it", "src0"), (None, "src1"), ("de", "wiki"), ("en", None), ("fr", "src7"), (None, None)]
    docs = [doc(None if i % 17 == 3 else i, texts[i % len(texts)] if i % 3 else prose(i), *names[i % len(names)]) for i in range(300)]
    folder = stored(spark, tmp_path, docs)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet')")
    found_names, found = spark_rows(queries.QUERIES[name](spark, folder))
    want_names, want = duck_rows(con, queries.ORACLES[name])
    assert found_names == want_names
    assert found == want
