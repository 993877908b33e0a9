"""The divergence audit against its definition, in whole numbers of Python."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import divergence
from tests.compare import duck_rows, spark_rows

DOCS = "doc_id long, text string, lang string, source string"


def f(p, q):
    return (p - q) ** 2 // (p + q)


def by_definition(docs, min_docs=10, top=10):
    found = defaultdict(Counter)
    of_docs = defaultdict(Counter)
    for _, text, lang, source in docs:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        found[lang or "", source or ""].update(terms)
        of_docs[lang or ""].update(set(terms))
    out = []
    for lang, n_docs in of_docs.items():
        kept = sorted(t for t, n in n_docs.items() if n >= min_docs)
        groups = {s: {t: c[t] for t in kept} for (of, s), c in found.items() if of == lang}
        shares = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept)) for t in kept}
        p = {s: shares(c) for s, c in groups.items()}
        q = shares({t: sum(c[t] for c in groups.values()) for t in kept})
        for s in groups:
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in groups if o != s]
            terms = [(-f(p[s][t], q[t]), t.encode(), t) for t in kept if groups[s][t] and p[s][t] > q[t]]
            for part, rows in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item, -value, i + 1) for i, (value, _, item) in enumerate(rows)]
    return sorted(out)


def corpus(seed, n=400):
    rng = random.Random(seed)
    vocabulary = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)] + ["Ünder", "中文", "I", "naïve", "x1y"]
    docs = []
    for i in range(n):
        lang, source = rng.choice(["en", "en", "en", "de", None, ""]), rng.choice(["hot", "hot", "hot", "s1", "s2", None, "é", "z"])
        shift = len(source or "") * 7
        docs.append((i, " ".join(vocabulary[min(len(vocabulary) - 1, int(rng.expovariate(0.06)) + rng.choice([0, shift]))] for _ in range(rng.randrange(30))), lang, source))
    return docs


def rows_of(spark, docs):
    return sorted(tuple(r) for r in divergence.audit(spark.createDataFrame(docs, DOCS)).select("lang", "source", "part", "item", "value", "rank").collect())


def test_as_defined(spark):
    docs = corpus(1)
    long = (1000, "common " * 300_000 + "wb " * 5, "en", "long")
    odd = [(None, None, "fr", "a"), (None, "", "fr", "b"), (1, "few words", "fr", "a"), (2, "!!! 123", "it", None), long, *docs[:30], *docs[:30]]
    found = rows_of(spark, docs + odd)
    assert found == by_definition(docs + odd)
    assert ("fr", "a", "pair", "b", 0, 1) in found and not any(r[0] == "it" for r in found)


def test_partitions_and_flushes_change_nothing(spark, monkeypatch):
    docs = corpus(2)
    want = by_definition(docs)
    monkeypatch.setattr(divergence, "MOST", 5)
    monkeypatch.setattr(divergence, "STRETCH", 3)
    monkeypatch.setattr(divergence, "PAIRS", 4)
    frame = spark.createDataFrame(docs, DOCS).repartition(7).withColumns({c: F.lit("mine") for c in ("term", "n", "docs", "idx", "p", "q", "value", "rank")})
    assert sorted(tuple(r) for r in divergence.audit(frame).collect()) == want


def test_empty_table_and_sql(spark, tmp_path):
    assert rows_of(spark, []) == []
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(corpus(3), DOCS).write.parquet(path)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/*.parquet')")
    assert spark_rows(divergence.audit(spark.read.parquet(path))) == duck_rows(con, divergence.ORACLE)


def test_shares_of_large_counts(spark):
    rows = [(n, total, v) for n in (0, 1, 10**13) for total in (1, 3 * 10**13 + 7) for v in (1, 12345)]
    found = spark.createDataFrame(rows, "n long, total long, v long").select("*", divergence.share("n", "total", "v").alias("p")).collect()
    assert all(r.p == 1 + 10**9 * (r.n + 2) // (r.total + 2 * r.v) for r in found if r.n <= r.total)


def test_nodes_share_beginnings():
    """Four paths: abc, abd, ab, b; a and ab are one node each."""
    paths = [[(0, 1), (1, 1)], [(0, 1), (1, 1), (2, 5)], [(0, 1), (1, 1), (3, 5)], [(1, 1)]]
    offsets = np.cumsum([0, *map(len, paths)])
    nodes = divergence.tree_nodes(np.zeros(4, int), offsets, np.array([i for p in paths for i in p]), np.array([2, 3, 5, 7]))
    assert sorted(zip(*(x.tolist() for x in nodes), strict=True)) == [(0, 0, 10), (0, 1, 10), (1, 2, 3), (2, 2, 5), (3, 0, 7)]


@pytest.mark.parametrize("seed", range(4))
def test_tree_sums_are_those_of_single_rows(seed):
    rng = random.Random(seed)
    rows = sorted(tuple((i, rng.randrange(1, 3)) for i in sorted(rng.sample(range(6), rng.randrange(2, 6)))) for _ in range(60))
    m = [rng.randrange(1, 9) for _ in rows]
    distinct = sorted(set(rows))
    weight = np.array([sum(w for r, w in zip(rows, m, strict=True) if r == d) for d in distinct])
    offsets, items = np.cumsum([0, *map(len, distinct)]), np.array([i for r in distinct for i in r])
    base = items[:, 0] + 100
    items = items * [1, 1000]
    got = Counter()
    for _, lo, hi, value in divergence.corrections(*divergence.tree_nodes(np.zeros(len(distinct), int), offsets, items, weight), offsets, items, base):
        for a, b, x in zip(lo.tolist(), hi.tolist(), value.tolist(), strict=True):
            got[a, b] += x
    want = Counter()
    for r, w in zip(rows, m, strict=True):
        for j, (b, y) in enumerate(r):
            for a, x in r[:j]:
                want[a, b] += w * (f(1000 * x, 1000 * y) - f(1000 * x, b + 100) - f(a + 100, 1000 * y) + f(a + 100, b + 100))
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}
