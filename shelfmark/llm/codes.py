"""Vector code compression: product codes whose codebooks are fitted through anchors-hierarchy metric trees.

Vectors are cut into ``PARTS`` parts; each part position has a codebook of ``ENTRIES`` entries, moved ``ROUNDS`` times to the
means of what is nearest to them. Components are whole numbers, floor(4096 x), so all sums and comparisons are exact and
the order of rows doesn't matter.

Each task cuts its rows into blocks of ``BLOCK`` and builds a metric tree over each part of a block, middle-out: about
sqrt(n) anchors are chosen, each the point farthest from its anchor so far, taking over the points that are nearer to it (only
points more than half as far from their anchor as the new one is can be); anchors are then joined two by two, the pair with the smallest
ball first, and each anchor's own points are treated in the same way. Every ball caches its count and the sum of its points. The trees are a table
that is written once and serves all rounds.

In a round a ball inherits its parent's list of candidate entries and strikes those that can't be nearest to any of its
points: the ball lies wholly on the nearer side of the plane between such an entry and the entry nearest to its centre. A
ball with one candidate left is wholly owned and adds its cached sum and count; in a leaf points meet the candidates left.
The bound is in floating point with a margin, and strict, so ties are settled by points, to the lower index.

A task holds one block and adds up its blocks' sums; what goes to the driver is one codebook (PARTS x ENTRIES sums). Blocks are cut
where rows are, so nothing is shuffled for them and no value of any column can make one large.

Nulls and edges: a vector that is null, empty or holds null or non-finite components is dropped, and so is one whose length
isn't the most frequent (of two equally frequent ones, the shorter); with a length that PARTS doesn't divide the first parts are one
longer; a null vec_id is kept and comes last among the smallest, equal ids in the order of their vectors; with fewer than ENTRIES rows
the codebooks are shorter; repeated rows count each; null labels are one label; an empty table gives no rows; other columns are not
read. With components of 2**26 and more the sums are Python's whole numbers, up to 38 digits, beyond which the job fails; an
error that a long can't hold is null.
"""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm._session import table, written

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
BLOCK, LEAF = 4096, 24
#: From here on, sums of squares or of a block's points could leave 64 bits.
WIDE = 1 << 26

Nested = tuple | int


@dataclass
class Tree:
    """Balls in breadth-first order, the first being the root; the points order[first:end] are a ball's own.

    child is the place of the first of two children, which follow each other; 0 for a leaf. sums: of a ball's points.
    """

    order: np.ndarray
    first: np.ndarray
    end: np.ndarray
    child: np.ndarray
    radius: np.ndarray
    centre: np.ndarray
    sums: np.ndarray


def lengths(v: np.ndarray) -> np.ndarray:
    return np.sqrt((v**2).sum(-1))


def anchors(x: np.ndarray, most: int) -> list[np.ndarray]:
    """The points of each anchor: at most so many anchors, fewer if no point is off its anchor."""
    owner, far, places = np.zeros(len(x), np.int64), lengths(x - x[0]), [0]
    while len(places) < most and far.any():
        new = int(far.argmax())
        apart = lengths(x[places] - x[new])
        near = np.flatnonzero(far > apart[owner] / 2)  # the others can't be taken over
        d = lengths(x[near] - x[new])
        taken = d < far[near]
        owner[near[taken]], far[near[taken]] = len(places), d[taken]
        places.append(new)
    return [np.flatnonzero(owner == i) for i in range(len(places))]


def joined(x: np.ndarray, groups: list[np.ndarray]) -> Nested:
    """The numbers of the groups as nested pairs, joined from below, the pair with the smallest ball first."""
    tree: list[Nested] = list(range(len(groups)))
    size = np.array([len(g) for g in groups], float)
    centre = np.stack([x[g].mean(0) for g in groups])
    radius = np.array([lengths(x[g] - c).max() for g, c in zip(groups, centre, strict=True)])
    open_ = np.ones(len(groups), bool)

    def around(i: int) -> np.ndarray:
        """Radii of the balls that hold ball i and each other one that is still open."""
        middle = (centre * size[:, None] + centre[i] * size[i]) / (size + size[i])[:, None]
        both = np.maximum(lengths(centre - middle) + radius, lengths(centre[i] - middle) + radius[i])
        return np.where(open_ & (np.arange(len(both)) != i), both, np.inf)

    cost = np.stack([around(i) for i in range(len(groups))])
    last = 0
    for _ in groups[1:]:
        last, gone = divmod(int(cost.argmin()), len(groups))
        tree[last], radius[last] = (tree[last], tree[gone]), cost[last, gone]
        centre[last] = (centre[last] * size[last] + centre[gone] * size[gone]) / (size[last] + size[gone])
        size[last] += size[gone]
        open_[gone] = False
        cost[gone] = cost[:, gone] = np.inf
        cost[last] = cost[:, last] = around(last)
    return tree[last]


def hierarchy(x: np.ndarray, points: np.ndarray) -> tuple | np.ndarray:
    """Nested pairs with arrays of points as leaves."""
    groups = anchors(x[points], max(2, int(np.sqrt(len(points))))) if len(points) > LEAF else []
    if len(groups) < 2:  # few points, or equal ones
        return points
    below = [hierarchy(x, points[g]) for g in groups]
    put = lambda node: (put(node[0]), put(node[1])) if isinstance(node, tuple) else below[node]
    return put(joined(x[points], groups))


def leaves(node: tuple | np.ndarray) -> list[np.ndarray]:
    out, open_ = [], [node]
    while open_:
        own = open_.pop()
        if isinstance(own, tuple):
            open_ += own[::-1]
        else:
            out.append(own)
    return out


def ball_sums(x: np.ndarray, order: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    before = np.concatenate([np.zeros((1, x.shape[1]), x.dtype), np.cumsum(x[order], 0)])
    return before[end] - before[first]


def grow(x: np.ndarray) -> Tree:
    """The tree over the rows of x, whole numbers."""
    real = x.astype(np.float64)
    nodes: list = [hierarchy(real, np.arange(len(x)))]
    order, first, end, child = np.concatenate(leaves(nodes[0])), [0], [len(x)], []
    for at, node in enumerate(nodes):  # grows while it is walked
        child.append(len(nodes) if isinstance(node, tuple) else 0)
        if isinstance(node, tuple):
            middle = first[at] + sum(map(len, leaves(node[0])))
            nodes += node
            first += [first[at], middle]
            end += [middle, end[at]]
    own = [real[order[a:b]] for a, b in zip(first, end, strict=True)]
    centre = np.stack([o.mean(0) for o in own])
    radius = np.array([lengths(o - c).max() for o, c in zip(own, centre, strict=True)])
    ends = np.array(first), np.array(end)
    return Tree(order, *ends, np.array(child), radius, centre, ball_sums(x, order, *ends))


def walk(tree: Tree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Balls that are wholly owned and their entries; places of all other points, and a row of their candidates each."""
    c = entries.astype(np.float64)
    between = lengths(c[:, None] - c[None])
    margin = 1e-9 * (1 + (np.abs(c).max(initial=0) + np.abs(tree.centre).max(initial=0) + tree.radius.max()) ** 2 * c.shape[1])
    balls, able = np.zeros(1, np.int64), np.ones((1, len(c)), bool)
    owned, owners, places, candidates = [], [], [np.zeros(0, np.int64)], [able[:0]]
    while len(balls):
        far = ((tree.centre[balls, None] - c[None]) ** 2).sum(2)
        best = np.where(able, far, np.inf).argmin(1)
        nearest = far[np.arange(len(balls)), best]
        able = able & (far - nearest[:, None] <= 2 * tree.radius[balls, None] * between[best] + margin)
        one, leaf = able.sum(1) == 1, tree.child[balls] == 0
        owned.append(balls[one])
        owners.append(able[one].argmax(1))
        for ball, own in zip(balls[leaf & ~one], able[leaf & ~one], strict=True):
            places.append(np.arange(tree.first[ball], tree.end[ball]))
            candidates.append(np.broadcast_to(own, (len(places[-1]), len(c))))
        inner = ~one & ~leaf
        balls, able = np.repeat(tree.child[balls[inner]], 2), np.repeat(able[inner], 2, 0)
        balls[1::2] += 1
    return np.concatenate(owned), np.concatenate(owners), np.concatenate(places), np.concatenate(candidates)


def settled(x: np.ndarray, able: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """The nearest of its candidates for each row of x, ties to the lower index, in whole numbers."""
    best, least = np.full(len(x), -1), np.zeros(len(x), x.dtype)
    for k, entry in enumerate(entries):
        at = np.flatnonzero(able[:, k])
        d = ((x[at] - entry) ** 2).sum(1)
        nearer = (best[at] < 0) | (d < least[at])
        best[at[nearer]], least[at[nearer]] = k, d[nearer]
    return best


def assigned(tree: Tree, x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """The nearest entry of each row of x."""
    owned, owners, places, able = walk(tree, entries)
    out = np.empty(len(x), np.int64)
    for ball, entry in zip(owned, owners, strict=True):
        out[tree.order[tree.first[ball] : tree.end[ball]]] = entry
    out[tree.order[places]] = settled(x[tree.order[places]], able, entries)
    return out


def gathered(tree: Tree, x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum and count of the rows nearest to each entry."""
    owned, owners, places, able = walk(tree, entries)
    left = x[tree.order[places]]
    nearest = settled(left, able, entries)
    total, count = np.zeros(entries.shape, x.dtype), np.bincount(nearest, minlength=len(entries))
    np.add.at(total, owners, tree.sums[owned])
    np.add.at(total, nearest, left)
    np.add.at(count, owners, tree.end[owned] - tree.first[owned])
    return total, count


def cut(size: int, parts: int) -> list[tuple[int, int]]:
    """First and end of each part: as equal as can be."""
    edges = [i * (size // parts) + min(i, size % parts) for i in range(parts + 1)]
    return list(zip(edges[:-1], edges[1:], strict=True))


def whole(values: np.ndarray) -> np.ndarray:
    """floor(SCALE x) as whole numbers: of 64 bits where all sums fit, else Python's."""
    if np.abs(values).max(initial=0) < WIDE / SCALE:
        return np.floor(values * SCALE).astype(np.int64)
    return np.array([math.floor(Fraction(x) * SCALE) for x in values.ravel().tolist()], object).reshape(values.shape)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label as text, v as doubles, of the rows that take part."""
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("string"), F.col("embedding").cast("array<double>").alias("v")).filter("size(v) > 0")
    rows = rows.filter(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    usual = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1)
    return rows.join(F.broadcast(usual.select("d")), F.size("v") == F.col("d"), "left_semi")


TREES = pa.schema([("ids", pa.list_(pa.int64())), ("labels", pa.list_(pa.string())), ("v", pa.binary()), ("trees", pa.list_(pa.binary()))])


def packed(tree: Tree) -> bytes:
    """The balls count, then the arrays; sums that 64 bits don't hold are left out."""
    counts = np.array([len(tree.first), tree.sums.dtype == object], np.int32)
    held = [counts, *(a.astype(np.int32) for a in (tree.first, tree.end, tree.child)), tree.order.astype(np.int32)]
    raw = b"".join(a.tobytes() for a in held)
    return raw + bytes(-len(raw) % 8) + tree.radius.tobytes() + tree.centre.tobytes() + (b"" if counts[1] else tree.sums.tobytes())


def unpacked(raw: bytes, x: np.ndarray) -> Tree:
    """The tree over x again."""
    n, wide = np.frombuffer(raw, np.int32, 2)
    first, end, child = np.frombuffer(raw, np.int32, 3 * n, 8).reshape(3, n)
    order = np.frombuffer(raw, np.int32, len(x), at := 8 + 12 * int(n))
    at += 4 * len(x)
    at += -at % 8
    size = int(n) * x.shape[1]
    centre = np.frombuffer(raw, np.float64, size, at + 8 * int(n)).reshape(n, -1) if size else np.zeros((n, 0))
    sums = ball_sums(x, order, first, end) if wide or not size else np.frombuffer(raw, np.int64, size, at + 8 * int(n) + 8 * size).reshape(n, -1)
    return Tree(order, first, end, child, np.frombuffer(raw, np.float64, n, at), centre, sums)


def build(rows: DataFrame, parts: int, block: int = BLOCK) -> DataFrame:
    """A row for each block of vectors: ids, labels, components and a tree for each part; written once."""

    def grown(ids: list, labels: list, v: list[np.ndarray]) -> pa.RecordBatch:
        x = np.stack(v)
        trees = [packed(grow(whole(x[:, a:b]))) for a, b in cut(x.shape[1], parts)]
        return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip((ids, labels, x.tobytes(), trees), TREES.types, strict=True)], schema=TREES)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, v = [], [], []
        for batch in batches:
            for i, label, values in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                ids.append(i)
                labels.append(label)
                v.append(values.values.to_numpy())
                if len(ids) == block:
                    yield grown(ids, labels, v)
                    ids, labels, v = [], [], []
        if ids:
            yield grown(ids, labels, v)

    return written(rows.select("vec_id", "label", "v").mapInArrow(make, "ids array<long>, labels array<string>, v binary, trees array<binary>"), "metric-trees")


def held_blocks(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[tuple[list, list, list[tuple[np.ndarray, Tree]]]]:
    """ids, labels, and the whole numbers and tree of each part."""
    for batch in batches:
        for i in range(batch.num_rows):
            ids, labels, v, trees = (batch.column(c)[i].as_py() for c in range(4))
            x = np.frombuffer(v, np.float64).reshape(len(ids), -1)
            own = [whole(x[:, a:b]) for a, b in cut(x.shape[1], parts)]
            yield ids, labels, [(x, unpacked(raw, x)) for x, raw in zip(own, trees, strict=True)]


def first_codebooks(rows: DataFrame, parts: int, entries: int) -> list[np.ndarray]:
    """The parts of the smallest ids' vectors."""
    chosen = np.array([r.v for r in rows.orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).select("v").collect()])
    return [whole(chosen[:, a:b]) for a, b in cut(chosen.shape[1], parts)] if len(chosen) else []


def next_codebooks(trees: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """One round: every entry becomes the floor of the mean of what is nearest to it; unused ones stay."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: defaultdict[tuple[int, int, int], int] = defaultdict(int)
        for _, _, own in held_blocks(batches, len(books)):
            for part, (x, tree) in enumerate(own):
                for entry, (total, count) in enumerate(zip(*gathered(tree, x, books[part]), strict=True)):
                    for place, value in enumerate((count, *total), -1):
                        held[part, entry, place] += int(value)
        part, entry, place = zip(*held, strict=True) if held else ((), (), ())
        yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int32()) for c in (part, entry, place)), pa.array(map(str, held.values()), pa.string())], names=["part", "entry", "place", "value"])

    sums = trees.mapInArrow(add, "part int, entry int, place int, value string").groupBy("part", "entry", "place").agg(F.sum(F.col("value").cast("decimal(38, 0)")).alias("value"))
    found = {(r.part, r.entry, r.place): int(r.value) for r in sums.collect()}
    out = []
    for part, book in enumerate(books):
        new = book.astype(object)
        for entry in range(len(book)):
            if count := found.get((part, entry, -1), 0):
                new[entry] = [found[part, entry, place] // count for place in range(book.shape[1])]
        out.append(new if book.dtype == object or max(map(abs, new.ravel()), default=0) >= WIDE else new.astype(np.int64))
    return out


def codes_of(trees: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """vec_id, label, code, error: for each vector the nearest entry of each part, and the squared distances added up."""
    names = ["vec_id", "label", "code", "error"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, labels, own in held_blocks(batches, len(books)):
            nearest = np.stack([assigned(tree, x, book) for (x, tree), book in zip(own, books, strict=True)], 1)
            errors = sum(((x - book[k]) ** 2).sum(1) for (x, _), book, k in zip(own, books, nearest.T, strict=True))
            codes = [row.tobytes().hex() for row in nearest.astype(np.uint8)]
            errors = [x if x < 1 << 63 else None for x in map(int, errors)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(labels, pa.string()), pa.array(codes, pa.string()), pa.array(errors, pa.int64())], names=names)

    return trees.mapInArrow(encode, "vec_id long, label string, code string, error long")


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, block: int = BLOCK) -> tuple[DataFrame, list[np.ndarray]]:
    """The codes (see codes_of), as a written table, and the codebooks."""
    if entries > 256:
        raise ValueError("a code has a byte for each part")
    rows = usable(vectors)
    books, trees = first_codebooks(rows, parts, entries), build(rows, parts, block)
    for _ in range(rounds if books else 0):
        books = next_codebooks(trees, books)
    return written(codes_of(trees, books), "vector-codes"), books


def decompressed(code: str, books: list[np.ndarray]) -> np.ndarray:
    """The whole numbers that a code stands for."""
    return np.concatenate([book[i] for i, book in zip(bytes.fromhex(code), books, strict=True)])


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = compress(table(spark, sf_dir, "embeddings"))
    digest = hashlib.sha256(",".join(str(int(x)) for book in books for x in book.ravel()).encode()).hexdigest()
    of_label = codes.groupBy(F.col("label").alias("own")).agg(F.try_sum("error").alias("label_error"))
    joined_ = codes.join(of_label, F.col("label").eqNullSafe(F.col("own")))
    return joined_.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def oracle() -> str:
    """The same in SQL, for vectors whose length is a multiple of PARTS: each round is a join with all entries."""
    steps = []
    for i in range(ROUNDS + 1):
        steps.append(f"""far{i} AS MATERIALIZED (SELECT r, part, entry, sum((c.x - b.x) * (c.x - b.x)) AS d FROM c JOIN book{i} b USING (part, place) GROUP BY r, part, entry),
near{i} AS MATERIALIZED (SELECT r, part, arg_min(entry, d * {ENTRIES} + entry) AS entry, min(d) AS d FROM far{i} GROUP BY r, part)""")
        if i < ROUNDS:
            steps.append(f"""mean{i} AS (SELECT part, entry, place, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS n FROM c JOIN near{i} USING (r, part) GROUP BY part, entry, place),
book{i + 1} AS MATERIALIZED (SELECT b.part, b.entry, b.place, coalesce((s - (s % n + n) % n) // n, b.x)::BIGINT AS x FROM book{i} b LEFT JOIN mean{i} USING (part, entry, place))""")
    return f"""
WITH own AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id, embedding) - 1 AS r, vec_id, label, embedding AS v, len(embedding) // {PARTS} AS width FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c AS MATERIALIZED (SELECT r, (i // width)::INT AS part, (i % width)::INT AS place, floor({SCALE} * v[i + 1]::DOUBLE)::BIGINT AS x FROM (SELECT r, v, width, unnest(range(len(v))) AS i FROM own)),
book0 AS MATERIALIZED (SELECT part, r AS entry, place, x FROM c WHERE r < {ENTRIES}),
{', '.join(steps)},
code AS (SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM near{ROUNDS} GROUP BY r)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, place)) FROM book{ROUNDS}) AS codebooks_sha256
FROM own JOIN code USING (r)
"""
