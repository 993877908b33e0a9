"""Source divergence audit: how the sources of a language differ in their words, by a frequent-pattern tree of term rows.

Every term is a row of the counts that sources have of it, zeros left out, the sources in order of their size. Of two
sources the divergence is a sum over all kept terms; with ``f`` the divergence of two shares and ``0`` marking the share of
a term that a source lacks, it is taken apart exactly:

    sum f(p, q) = V f(p0, q0) + sum over p's terms of (f(p, q0) - f(p0, q0)) + the same for q
                + sum over the terms of both of (f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0))

The first two need a source's shares with their multiplicities only. The last is the pair correction. Rows that are equal
are counted first; sorted, the rows of a partition are the paths of a frequent-pattern tree, in which rows that begin with the same (source,
share) items share nodes. Each node's multiplicity is the sum over the rows below it, and each node meets each of its
ancestors once, whatever the number of terms that pass through both. Partial sums are added up over partitions.

Counts are summed in each task before the shuffle, then by (lang, source, term), so a hot source or word is many small keys. A
term row has at most one item for each source, a source at most sqrt(2 N) different counts; the paths are dealt by range,
after equal ones were merged. All arithmetic is in whole numbers.

Nulls and edges: null lang, source and text are ''; empty texts make their group occur; a very long text is cut into words in
stretches, of which its distinct words are held; repeated rows are documents of their own; ties are ranked by the item in
UTF-8; a language without kept terms has pairs of value 0; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.llm._session import table, written

SCALE, MIN_DOCS, TOP = 1_000_000_000, 10, 10
#: Counters of a task before they are sent on, bytes of a text that are cut into words at once, node-ancestor pairs at once.
MOST, STRETCH, PAIRS = 1 << 19, 1 << 22, 1 << 20
#: Paths are dealt to partitions of so many, and to at most so many, as Spark samples each partition's paths on the driver.
RANGE_ROWS, RANGES = 20_000, 1024

#: A-Z to lower case; letters and bytes of other characters stay, all else separates.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(raw: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in stretches that end between terms."""
    raw, at = raw.translate(_WORDS), 0
    while at < len(raw):
        to = raw.find(b" ", at + STRETCH)
        to = len(raw) if to < 0 else to
        yield raw[at:to].split()
        at = to


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n, docs: occurrences, and documents that have the term."""
    own = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    schema = "lang string, source string, term string, n long, docs long"

    def rows(held: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
        for (lang, source), (counts, docs_of) in held.items():
            n = len(counts)
            columns = [pa.array([lang] * n, pa.string()), pa.array([source] * n, pa.string()), pa.array(list(counts), pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(list(counts.values()), pa.int64()), pa.array([docs_of[t] for t in counts], pa.int64())], names=["lang", "source", "term", "n", "docs"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0
        for batch in batches:
            for lang, source, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()), strict=True):
                counts, docs_of = held.setdefault((lang, source), (Counter(), Counter()))
                size -= len(counts)
                seen: set[bytes] = set()
                for part in words(raw.as_py()):
                    counts.update(part)
                    seen.update(part)
                docs_of.update(seen)
                size += len(counts)
                if size >= MOST:
                    yield from rows(held)
                    held, size = {}, 0
        yield from rows(held)

    return own.mapInArrow(count, schema).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: str, total: str, terms: str) -> Column:
    """1 + floor(SCALE (n + 2) / (total + 2 terms)), in decimals, which hold the product; 1 without terms."""
    return F.expr(f"CASE WHEN {terms} > 0 THEN 1 + (CAST({SCALE} AS DECIMAL(10, 0)) * CAST({n} + 2 AS DECIMAL(20, 0))) div CAST({total} + 2 * {terms} AS DECIMAL(20, 0)) ELSE 1 END").cast("long")


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)), of whole numbers from 1 to SCALE + 1."""
    return (p - q) ** 2 // (p + q)


def kept_rows(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, term, total, cells (source, n): a row for each kept term of a language; written once."""
    rows = term_counts(docs).groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("cells"))
    return written(rows.filter(F.col("docs") >= min_docs).drop("docs"), "term-rows")


def groups_of(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, size, terms, lang_size, idx, p0 for each group that occurs; idx puts the largest source of a language first."""
    found = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    sizes = kept.select("lang", F.explode("cells").alias("c")).groupBy("lang", F.col("c.source").alias("source")).agg(F.sum("c.n").alias("size"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("total").alias("lang_size"))
    whole = found.join(sizes, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0, ["size", "terms", "lang_size"])
    numbered = whole.withColumn("idx", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("size"), "source")) - 1)
    return written(numbered.withColumn("p0", share("0", "size", "terms")), "source-groups")


def paths_of(shares: DataFrame, ranges: int) -> DataFrame:
    """lang, path, m: the distinct term rows in tree order within each partition, and how many terms have each."""
    rows = shares.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("idx", "p", "p0"))).alias("path")).filter(F.size("path") > 1)
    return rows.groupBy("lang", "path").agg(F.count("*").alias("m")).repartitionByRange(ranges, "lang", "path").sortWithinPartitions("lang", "path")


def tree_nodes(lang: np.ndarray, offsets: np.ndarray, items: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, depth and multiplicity of the nodes of the tree of sorted paths: a node stands where a path leaves the one before.

    offsets: where each path begins among the items (a row for each, by which they are compared).
    """
    size = np.diff(offsets)
    row = np.repeat(np.arange(len(size)), size)
    depth = np.arange(len(items)) - offsets[row]
    before = np.where(row > 0, offsets[row - 1] + depth, 0)
    same = (row > 0) & (depth < size[row - 1]) & (lang[row] == lang[row - 1])
    same &= (items[np.minimum(before, len(items) - 1)] == items).all(1)
    common = size.copy()
    np.minimum.at(common, row[~same], depth[~same])
    is_node, sums = depth >= common[row], np.concatenate([[0], np.cumsum(m)])
    rows, depths, weights = [], [], []
    for d in range(int(size.max(initial=0))):
        at = row[is_node & (depth == d)]
        ends = np.append(np.flatnonzero(common <= d), len(size))  # a path that leaves here or above ends the node before
        rows.append(at)
        depths.append(np.full(len(at), d))
        weights.append(sums[ends[np.searchsorted(ends, at, "right")]] - sums[at])
    return np.concatenate(rows), np.concatenate(depths), np.concatenate(weights)


def corrections(rows: np.ndarray, depths: np.ndarray, weights: np.ndarray, offsets: np.ndarray, items: np.ndarray, base: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, ancestor's idx, node's idx, correction) for each node and ancestor, a bounded number at a time."""
    edges = np.cumsum(depths)
    at = 0
    while at < len(rows):
        to = max(at + 1, int(np.searchsorted(edges, (edges[at - 1] if at else 0) + PAIRS, "right")))
        r, d, w = rows[at:to], depths[at:to], weights[at:to]
        node = np.repeat(offsets[r] + d, d)
        above = np.repeat(offsets[r], d) + np.arange(len(node)) - np.repeat(np.cumsum(d) - d, d)
        p, q, p0, q0 = items[node, 1], items[above, 1], base[node], base[above]
        value = divergence(p, q) - divergence(p, q0) - divergence(p0, q) + divergence(p0, q0)
        yield np.repeat(r, d), items[above, 0], items[node, 0], value * np.repeat(w, d)
        at = to


SUMS = "lang string, lo int, hi int, value long"


def _batch(held: dict[tuple[str, int, int], int]) -> pa.RecordBatch:
    lang, lo, hi = zip(*held, strict=True) if held else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(lo, pa.int32()), pa.array(hi, pa.int32()), pa.array(list(held.values()), pa.int64())], names=["lang", "lo", "hi", "value"])


def shared_terms(shares: DataFrame, ranges: int) -> DataFrame:
    """lang, lo, hi, value: the corrections of pairs of sources, from the trees of the partitions; to be added up."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int, int], int] = {}
        for batch in (b for b in batches if b.num_rows):
            path = batch.column(1)
            offsets = np.asarray(path.offsets, np.int64)
            cells = path.values.slice(offsets[0], offsets[-1] - offsets[0])
            idx, p, base = (np.asarray(cells.field(i), np.int64) for i in range(3))
            offsets, items = offsets - offsets[0], np.stack([idx, p], 1)
            names = batch.column(0).to_pylist()
            langs = sorted(set(names))
            code = np.searchsorted(np.array(langs, object), np.array(names, object))
            width = int(idx.max(initial=0)) + 1
            nodes = tree_nodes(code, offsets, items, np.asarray(batch.column(2), np.int64))
            for row, lo, hi, value in corrections(*nodes, offsets, items, base):
                keys, which = np.unique((code[row] * width + lo) * width + hi, return_inverse=True)
                sums = np.zeros(len(keys), np.int64)
                np.add.at(sums, which, value)
                for key, x in zip(keys.tolist(), sums.tolist(), strict=True):
                    own = (langs[key // width // width], key // width % width, key % width)
                    held[own] = held.get(own, 0) + x
                if len(held) >= MOST:
                    yield _batch(held)
                    held = {}
        yield _batch(held)

    return paths_of(shares, ranges).mapInArrow(walk, SUMS)


def own_terms(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, lo, hi, value: what a source's own shares give against the base shares of each other; to be added up."""
    of_shares = shares.groupBy("lang", "idx", "p").agg(F.count("*").alias("m")).groupBy("lang", "idx").agg(F.collect_list(F.struct("p", "m")).alias("shares"))
    bases = groups.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("idx", "p0"))).alias("bases"))
    rows = groups.select("lang", "idx", "p0", "terms").join(of_shares, ["lang", "idx"], "left").join(bases.select("lang", "bases.p0"), "lang")
    rows = rows.toDF("lang", "idx", "p0", "terms", "shares", "bases").repartition("lang", "idx")

    def against(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                lang, idx, p0, terms = (batch.column(i)[row].as_py() for i in range(4))
                held, bases = batch.column(4)[row], np.asarray(batch.column(5)[row].values, np.int64)
                p, m = (np.asarray(held.values.field(i), np.int64) if held.is_valid else np.zeros(0, np.int64) for i in range(2))
                none = divergence(np.int64(p0), bases)
                value = np.where(np.arange(len(bases)) > idx, terms, 0) * none - m.sum() * none
                step = max(1, PAIRS // max(1, len(bases)))
                for at in range(0, len(p), step):
                    value += (divergence(p[at : at + step, None], bases[None]) * m[at : at + step, None]).sum(0)
                yield _batch({(lang, min(idx, h), max(idx, h)): x for h, x in enumerate(value.tolist()) if h != idx})

    return rows.mapInArrow(against, SUMS)


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank: the divergence of each two sources, and the terms that a source has more of."""
    kept = kept_rows(docs, min_docs)
    groups = groups_of(docs, kept)
    cells = kept.select("lang", "term", "total", F.explode("cells").alias("c")).select("lang", "term", "total", "c.*")
    shares = cells.join(groups, ["lang", "source"]).withColumn("p", share("n", "size", "terms")).withColumn("q", share("total", "lang_size", "terms"))
    sums = shared_terms(shares, min(RANGES, 1 + kept.count() // RANGE_ROWS)).unionByName(own_terms(shares, groups)).groupBy("lang", "lo", "hi").agg(F.sum("value").alias("value"))
    both = F.explode(F.array(F.struct(F.col("lo").alias("a"), F.col("hi").alias("b")), F.struct(F.col("hi").alias("a"), F.col("lo").alias("b"))))
    named = lambda idx, name: groups.select("lang", F.col("idx").alias(idx), F.col("source").alias(name))
    pairs = sums.select("lang", "value", both.alias("x")).select("lang", "value", "x.*").join(named("a", "source"), ["lang", "a"]).join(named("b", "item"), ["lang", "b"])
    more = shares.filter("p > q").select("lang", "source", F.col("term").alias("item"), F.expr("(p - q) * (p - q) div (p + q)").alias("value"))
    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    columns = ("lang", "source", "part", "item", "value", "rank")
    of_pairs = pairs.withColumns({"part": F.lit("pair"), "rank": F.row_number().over(by)}).select(*columns)
    return of_pairs.unionByName(more.withColumns({"part": F.lit("term"), "rank": F.row_number().over(by)}).filter(F.col("rank") <= top).select(*columns))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


ORACLE = rf"""
WITH doc AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
occurs AS (SELECT lang, source, r, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM doc),
kept AS (SELECT lang, term, count(*) AS total FROM occurs GROUP BY lang, term HAVING count(DISTINCT r) >= {MIN_DOCS}),
cell AS (SELECT lang, source, term, count(*) AS n FROM occurs SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
language AS (SELECT lang, count(*) AS v, sum(total)::BIGINT AS n FROM kept GROUP BY lang),
size AS (SELECT lang, source, sum(n)::BIGINT AS n FROM cell GROUP BY lang, source),
grp AS (SELECT lang, source, coalesce(v, 0) AS v, coalesce(size.n, 0) AS n FROM (SELECT DISTINCT lang, source FROM doc) LEFT JOIN language USING (lang) LEFT JOIN size USING (lang, source)),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + ({SCALE}::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.n + 2 * g.v) AS p,
    1 + ({SCALE}::HUGEINT * (k.total + 2)) // (l.n + 2 * l.v) AS q
  FROM grp g JOIN kept k USING (lang) JOIN language l USING (lang) LEFT JOIN cell c USING (lang, source, term)),
pair AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(value, 0)::BIGINT AS value FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source),
terms AS (SELECT lang, source, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
  UNION ALL SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) FROM terms QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) <= {TOP})
SELECT lang, source, part, item, value, rank::INT AS rank FROM ranked
"""
