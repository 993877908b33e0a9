"""Approximate nearest neighbours: a permutation index.

Every vector is represented by its ``NEAREST`` nearest of ``PIVOTS`` pivots, in order, and posted with its place in
that order in the inverted file of each. A query reads the files of its own ``READS`` nearest pivots; with places
beyond the list counting as one more, Spearman's footrule between two lists is a constant less the sum over shared
pivots of 2 (m - max(place, place')), so it is accumulated from postings alone. The ``RERANK`` sqrt(n) vectors with
the smallest footrule, of n in all, are ranked anew by the exact distance: a share that shrinks as the table grows.

Pivots come from a bounded sample (``PIVOTS`` distinct vectors with the smallest hashes); every vector is indexed.
The index is a table that is written once: blocks of about ``BLOCK`` vectors, each with its own inverted files. The
stated queries meet it in blocks too; a task holds one block of each, so its memory is bounded, and sends on k rows
for a query, of the block's part of what is ranked anew. Equal vectors are indexed once, with their k + 1 smallest
ids, which are all that can be among k neighbours; they are gathered under a salt first. Nothing is broadcast but
the pivots.

Nulls and edges: vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do
those with another length than most; rows without vec_id neither; a repeated row counts once, and of an id with
several vectors the nearest counts; with fewer than k candidates all are returned; an empty table gives none; other
columns are not read, whatever their names. Rows of a block are in the order of their smallest ids, so that of equal footrules
at the cut the smaller ids are ranked anew, however the table was dealt.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.llm._session import table, written

PIVOTS, NEAREST, READS, RERANK = 384, 96, 64, 10.0
BLOCK, QUERY_BLOCK, SALTS = 4096, 2048, 16
K = 10


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and the vector as doubles, for the rows that take part."""
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("v")).filter("vec_id is not null and size(v) > 0")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(finite & F.exists("v", lambda x: x != 0))
    usual = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1)
    return rows.join(F.broadcast(usual.select("d")), F.size("v") == F.col("d"), "left_semi")


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """v and ids: the k + 1 smallest ids of each distinct vector, ascending."""
    salt = F.pmod(F.xxhash64("vec_id"), F.lit(SALTS))
    some = rows.distinct().withColumn("i", F.row_number().over(Window.partitionBy("v", salt).orderBy("vec_id"))).filter(F.col("i") <= k + 1)
    return some.groupBy("v").agg(F.slice(F.sort_array(F.collect_list("vec_id")), 1, k + 1).alias("ids"))


def nearest_pivots(x: np.ndarray, pivots: np.ndarray, m: int) -> np.ndarray:
    """The numbers of each row's m nearest pivots, nearest first; ties to the smaller number."""
    d = (pivots**2).sum(1)[None] - 2 * x @ pivots.T
    return np.argsort(d, axis=1, kind="stable")[:, :m]


class Block:
    """The inverted files of one block: for each pivot the rows that have it among their nearest, and its place."""

    def __init__(self, x: np.ndarray, m: int, edge: np.ndarray, rows: np.ndarray, places: np.ndarray):
        self.x, self.m, self.edge, self.rows, self.places = x, m, edge, rows, places

    @staticmethod
    def posted(x: np.ndarray, pivots: np.ndarray, m: int) -> Block:
        m = min(m, len(pivots))
        near = nearest_pivots(x, pivots, m)
        order = np.argsort(near, axis=None, kind="stable")
        rows, places = np.divmod(order, m)
        edge = np.searchsorted(near.ravel()[order], np.arange(len(pivots) + 1))
        return Block(x, m, edge.astype(np.int64), rows.astype(np.int32), places.astype(np.int16))

    def shared(self, near: np.ndarray) -> np.ndarray:
        """For each row the sum over shared pivots that falls as the footrule grows; only the files of ``near`` are read."""
        out = np.zeros(len(self.x), np.int64)
        for place, p in enumerate(near.tolist()):
            a, b = self.edge[p], self.edge[p + 1]
            out[self.rows[a:b]] += np.maximum(self.m - np.maximum(self.places[a:b], place), 0)
        return out

    def search(self, q: np.ndarray, near: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and exact distances of the ``most`` rows with the smallest footrule to q."""
        if most < len(self.x):
            rows = np.argsort(-self.shared(near), kind="stable")[:most]
        else:
            rows = np.arange(len(self.x))
        return rows, np.sqrt(((self.x[rows] - q) ** 2).sum(1))


INDEX = "vb int, n int, ids array<array<long>>, x binary, edge binary, rows binary, places binary"


def build(vectors: DataFrame, points: np.ndarray, nearest: int, blocks: int) -> DataFrame:
    """The index: a row for each block of distinct vectors (v, ids), with its inverted files; written once."""

    def post(held: pd.DataFrame) -> pd.DataFrame:
        held = held.iloc[np.argsort([ids[0] for ids in held["ids"]], kind="stable")]
        x = np.stack(held["v"].to_numpy()).astype(np.float64)
        files = Block.posted(x, points, nearest)
        packed = [y.tobytes() for y in (x, files.edge, files.rows, files.places)]
        return pd.DataFrame([(held["vb"].iloc[0], len(x), held["ids"].tolist(), *packed)], columns=[c.split()[0] for c in INDEX.split(", ")])

    dealt = vectors.withColumn("vb", F.pmod(F.xxhash64("v"), F.lit(blocks)).cast("int"))
    return written(dealt.groupBy("vb").applyInPandas(post, INDEX), "permutation-index")


def search(
    vectors: DataFrame, queries: DataFrame, k: int = K, pivots: int = PIVOTS, nearest: int = NEAREST, reads: int = READS, rerank: float = RERANK, block: int = BLOCK
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows of ``vectors`` found for each row of ``queries``, without its own."""
    rows = written(usable(vectors), "vectors")
    asked = usable(queries).distinct()
    distinct = written(distinct_vectors(rows, k), "distinct-vectors")
    chosen = distinct.orderBy(F.xxhash64("v"), "v").limit(pivots).select("v").collect()
    n, n_asked = distinct.count(), asked.count()
    if not n or not n_asked:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    points = np.array([r.v for r in chosen])
    m, share = min(nearest, len(points)), rerank / math.sqrt(n)
    blocks, asked_blocks = math.ceil(n / block), math.ceil(n_asked / QUERY_BLOCK)
    index = build(distinct, points, nearest, blocks)

    def meet(asked_rows: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int, float]] = []
        if len(held) and len(asked_rows):
            own = held.iloc[0]
            x = np.frombuffer(own["x"], np.float64).reshape(own["n"], -1)
            part = Block(x, m, *(np.frombuffer(own[c], t) for c, t in (("edge", np.int64), ("rows", np.int32), ("places", np.int16))))
            ids = list(own["ids"])
            most = min(len(x), max(k + 1, math.ceil(share * len(x))))
            wanted = np.stack(asked_rows["v"].to_numpy()).astype(np.float64)
            for query_id, q, near in zip(asked_rows["vec_id"].tolist(), wanted, nearest_pivots(wanted, points, min(reads, m)), strict=True):
                at, far = part.search(q, near, most)
                some = at[np.argpartition(far, k)[: k + 1]] if len(at) > k + 1 else at
                limit = max(far[np.isin(at, some)])
                nearer = [(d, i) for r, d in zip(at.tolist(), far.tolist(), strict=True) if d <= limit for i in ids[r].tolist() if i != query_id]
                found += [(query_id, i, d) for d, i in sorted(nearer)[:k]]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    left = asked.withColumn("qb", F.pmod(F.xxhash64("vec_id"), F.lit(asked_blocks)).cast("int")).withColumn("vb", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = index.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(asked_blocks - 1))))
    met = left.groupBy("vb", "qb").cogroup(right.groupBy("vb", "qb")).applyInPandas(meet, "query_id long, vec_id long, score double")
    best = met.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.filter("vec_id % 100 = 0"))
