"""Vector codes against the plain algorithm, in whole numbers of Python, and the trees against brute force."""

from __future__ import annotations

import hashlib
import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import codes, queries
from tests.compare import duck_rows, spark_rows

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, parts=8, entries=16, rounds=6):
    """(vec_id, code, error, label_error) of each row, and the digest."""
    kept = [(i, [math.floor(4096 * x) for x in v], label) for i, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = len(kept[0][1])
    cuts = [(i * (size // parts) + min(i, size % parts), (i + 1) * (size // parts) + min(i + 1, size % parts)) for i in range(parts)]
    cut = [[tuple(v[a:b]) for a, b in cuts] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]
    far = lambda x, y: sum((a - b) ** 2 for a, b in zip(x, y, strict=True))
    nearest = lambda x, book: min(range(len(book)), key=lambda k: (far(x, book[k]), k))
    for _ in range(rounds):
        for p, book in enumerate(books):
            held = [[] for _ in book]
            for c in cut:
                held[nearest(c[p], book)].append(c[p])
            books[p] = [tuple(sum(x) // len(own) for x in zip(*own, strict=True)) if own else old for own, old in zip(held, book, strict=True)]
    out = []
    for (i, _, label), c in zip(kept, cut, strict=True):
        best = [nearest(x, book) for x, book in zip(c, books, strict=True)]
        out.append((i, bytes(best).hex(), sum(far(x, book[k]) for x, book, k in zip(c, books, best, strict=True)), label))
    sums = {label: sum(r[2] for r in out if r[3] == label) for label in {r[3] for r in out}}
    digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    return sorted((r[0] is None, r[0] or 0, r[1], r[2], sums[r[3]]) for r in out), digest


def found(spark, vectors, **more):
    made, books = codes.compress(vectors, **more)
    digest = hashlib.sha256(",".join(str(int(x)) for book in books for x in book.ravel()).encode()).hexdigest()
    rows = made.collect()
    sums = {label: sum(r.error for r in rows if r.label == label) for label in {r.label for r in rows}}
    return sorted((r.vec_id is None, r.vec_id or 0, r.code, r.error, sums[r.label]) for r in rows), digest


def vectors_of(seed, n, size, kind):
    rng = random.Random(seed)
    middles = [[rng.gauss(0, 1) for _ in range(size)] for _ in range(20)]
    make = {
        "balls": lambda: [m + rng.gauss(0, 0.05) for m in rng.choice(middles)],
        "sphere": lambda: [rng.gauss(0, 0.1) for _ in range(size)],
        "ties": lambda: [rng.choice([-0.5, 0.0, 0.5]) for _ in range(size)],
        "copies": lambda: rng.choice(middles[:3]),
    }[kind]
    return [(i, make(), rng.choice([1, 2, None])) for i in range(n)]


@pytest.mark.parametrize("kind", ["balls", "sphere", "ties", "copies"])
def test_as_the_plain_algorithm(spark, kind):
    rows = vectors_of(1, 300, 19, kind)
    frame = spark.createDataFrame(rows, SCHEMA)
    want = plain(rows)
    assert found(spark, frame.repartition(3)) == want
    assert found(spark, frame.orderBy(F.desc("vec_id")).coalesce(1), block=50) == want


def test_odd_rows(spark):
    rows = [
        (None, [0.5] * 8, 1), (3, [0.25] * 8, None), (3, [-0.3] * 8, None), (3, [-0.3] * 8, 2), (4, None, 1), (5, [], 1), (6, [float("nan")] * 8, 1), (7, [None] * 8, 1),
        (8, [float("inf")] * 8, 1), (-2, [-0.00001] * 8, 1), (9, [0.1] * 3, 1), (10, [0.2] * 8, 2), (None, [0.1, 0.2] * 4, None),
    ]
    kept = [r for r in rows if r[0] != 9]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("mine") for c in ("v", "code", "error", "own", "d", "part")})
    assert found(spark, frame) == plain(kept)
    none, books = codes.compress(frame.limit(0))
    assert none.count() == 0 and books == []


def test_large_components(spark):
    rows = vectors_of(3, 40, 8, "balls")
    rows = [(i, [x * (4e4 if i % 2 else 100) for x in v], label) for i, v, label in rows]
    assert found(spark, spark.createDataFrame(rows, SCHEMA), entries=3, block=16) == plain(rows, entries=3)
    huge = spark.createDataFrame([(1, [1e12] * 8, 1), (2, [-1e12] * 8, 1)], SCHEMA)
    assert [r.error for r in codes.compress(huge, entries=1)[0].collect()] == [None, None]


@pytest.mark.parametrize("kind", ["balls", "sphere", "ties", "copies"])
def test_trees_and_their_walk(kind):
    x = codes.whole(np.array([v for _, v, _ in vectors_of(4, 700, 5, kind)]))
    tree = codes.unpacked(codes.packed(codes.grow(x)), x)
    assert sorted(tree.order.tolist()) == list(range(len(x)))
    for first, end, child, radius, centre, sums in zip(tree.first, tree.end, tree.child, tree.radius, tree.centre, tree.sums, strict=True):
        own = x[tree.order[first:end]]
        assert (own.sum(0) == sums).all() and (codes.lengths(own - centre) <= radius + 1e-6).all()
        if child:
            assert (tree.first[child], tree.end[child], tree.end[child + 1]) == (first, tree.first[child + 1], end)
    entries = x[:16]
    far = ((x[:, None] - entries[None]) ** 2).sum(2)
    assert (codes.assigned(tree, x, entries) == far.argmin(1)).all()
    total, count = codes.gathered(tree, x, entries)
    assert all((total[k] == x[far.argmin(1) == k].sum(0)).all() and count[k] == (far.argmin(1) == k).sum() for k in range(16))
    if kind == "balls":
        assert sum(tree.end[b] - tree.first[b] for b in codes.walk(tree, entries)[0]) > len(x) / 2  # most points are never looked at


def test_codes_stand_for_their_entries(spark):
    made, books = codes.compress(spark.createDataFrame(vectors_of(5, 50, 16, "sphere"), SCHEMA))
    for r in made.collect():
        v = codes.whole(np.array(dict((i, v) for i, v, _ in vectors_of(5, 50, 16, "sphere"))[r.vec_id]))
        assert ((codes.decompressed(r.code, books) - v) ** 2).sum() == r.error


def test_query_and_sql(spark, tmp_path):
    path = str(tmp_path / "embeddings.parquet")
    rows = vectors_of(6, 200, 16, "ties") + [(500, None, 1), (501, [0.1] * 15 + [float("nan")], None)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(path)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{path}/*.parquet')")
    assert spark_rows(queries.QUERIES["op13_vector_codes"](spark, str(tmp_path))) == duck_rows(con, codes.oracle())
