"""Benchmark decontamination: SimHash over item-sized windows, looked up in a multi-index of Hamming blocks, then verified.

For each size that items have, windows of as many words slide over a text; a text with fewer words is one window, for
items up to 1 / ``SIMILARITY`` times its size. A window's 64-bit SimHash (of its word shingles, weighted by how often
they occur) is looked up in the index of that size: the fingerprints of all items of the size are cut into ``BLOCKS``
blocks, and each block has a table from its value to the items that have it. Of two fingerprints that differ in at
most ``RADIUS`` bits some block differs in at most ``RADIUS // BLOCKS``, so the items found in some table within that
distance of the window's block are all within the radius, and some others, which the whole distance drops. What is
left is verified by the exact weighted Jaccard similarity of its shingles (sum of minima over sum of maxima).

Windows that hold no shingle of any item of their size have similarity 0 to all of them, and get no fingerprint.
SimHash is a sketch: at similarity 0.8 fingerprints differ in 10 bits on average with a deviation of 3, so that a window
at the threshold lies beyond the radius of 23 about once in 10,000 to 100,000 times; more similar ones are safer.

Documents stay where they are: one scan, no shuffle. What goes to the tasks is the benchmark's index, as flat arrays, in
parts of at most ``PART_BYTES`` of text, each with a scan of its own.

Words are runs of letters and digits, case-folded in A-Z. Nulls and edges: a null or empty text has no windows; items
without words match nothing; an item with fewer words than a shingle is one shingle; items without item_id or repeated
ones are matched like any other, repeated (doc_id, item_id) pairs in one row of the table give one match, the best and
first; a long text is scanned whole; empty tables give an empty result; other columns are not read, and pass through
the filter as they are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm._session import table
from shelfmark.llm._text import ALNUM, few_rows, pieces, shingle_hashes, spans, word_hashes

K, SIMILARITY = 5, 0.8
RADIUS, BLOCKS = 23, 4
PART_BYTES = 32 << 20
#: Windows that are looked up at once.
ASKED = 2048
_BITS = np.array([bin(x).count("1") for x in range(1 << 16)], np.uint8)
SCHEMA = "doc_id long, item_id long, similarity double, start_word long, n_words long"


def fingerprints(shingles: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """SimHash of the windows of ``size`` shingles at these starts (ascending); repeated shingles weigh more."""
    out = np.empty(len(starts), np.uint64)
    for a in range(0, len(starts), 1 << 14):
        some = starts[a : a + (1 << 14)]
        used = np.unique((some[:, None] + np.arange(size)).ravel())
        bits = np.unpackbits(shingles[used].view(np.uint8).reshape(-1, 8), axis=1).astype(np.int32) * 2 - 1
        sums = np.vstack([np.zeros((1, 64), np.int32), np.cumsum(bits, axis=0)])
        at = np.searchsorted(used, some)
        votes = (sums[at + size] - sums[at]) >= 0  # windows are whole within used, as starts lie in one text each
        out[a : a + (1 << 14)] = np.packbits(votes, axis=1).view(np.uint64).ravel()
    return out


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard of two bags of shingles."""
    x, nx = np.unique(a, return_counts=True)
    y, ny = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    least = int(np.minimum(nx[i], ny[j]).sum())
    return least / (len(a) + len(b) - least)


def _ball(radius: int) -> np.ndarray:
    """The 16-bit masks with at most so many bits set."""
    return np.flatnonzero(_BITS <= radius).astype(np.uint16)


class BlockTable:
    """Fingerprints by the value of each of their blocks."""

    def __init__(self, prints: np.ndarray):
        self.prints = prints
        self.blocks = []
        for part in prints.view(np.uint16).reshape(-1, BLOCKS).T:
            order = np.argsort(part, kind="stable")
            values, first = np.unique(part[order], return_index=True)
            self.blocks.append((values, np.append(first, len(part)), order))

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(asked, held): the pairs of fingerprints that differ in at most RADIUS bits, each once."""
        pairs = []
        for block, asked in enumerate(prints.view(np.uint16).reshape(-1, BLOCKS).T):
            values, first, order = self.blocks[block]
            distinct, back = np.unique(asked, return_inverse=True)
            at, key = self._keys(values, distinct)
            # asked value -> keys of the table -> postings
            found = np.searchsorted(at, np.arange(len(distinct) + 1))
            own = np.repeat(np.arange(len(asked)), np.diff(found)[back])
            held = key[_ranges(found[back], np.diff(found)[back])]
            size = np.diff(first)[held]
            pairs.append(np.repeat(own, size) * len(self.prints) + order[_ranges(first[held], size)])
        asked, held = np.divmod(np.unique(np.concatenate(pairs)), len(self.prints))
        within = _BITS[(prints[asked] ^ self.prints[held]).view(np.uint16).reshape(-1, BLOCKS)].sum(1, dtype=np.int64) <= RADIUS
        return asked[within], held[within]

    @staticmethod
    def _keys(values: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of an asked value, index of a table's value) for those within the block's radius: by walking the table's
        values or by flipping bits, whichever is less."""
        masks = _ball(RADIUS // BLOCKS)
        if len(values) <= len(masks):
            near = _BITS[asked[:, None] ^ values[None]] <= RADIUS // BLOCKS
            return np.nonzero(near)
        place = np.full(1 << 16, -1, np.int32)
        place[values] = np.arange(len(values))
        met = [place[a ^ masks] for a in asked]
        hits = [x[x >= 0] for x in met]
        return np.repeat(np.arange(len(asked)), [len(x) for x in hits]), np.concatenate([*hits, place[:0]])


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0] .. starts[0] + sizes[0] - 1, then those of the next, and so on."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes - starts, sizes)


class Size:
    """The items with one number of shingles: where their shingles stand, and the index of their fingerprints."""

    def __init__(self, k: int, n: int, ids: list[int | None], shingles: list[np.ndarray]):
        self.k, self.n, self.ids = k, n, ids
        self.flat = np.concatenate(shingles).reshape(len(ids), n)
        self.table = BlockTable(fingerprints(self.flat.ravel(), np.arange(len(ids)) * n, n))

    def matches(self, shingles: np.ndarray, hits: np.ndarray, out: dict[int | None, tuple[float, int, int]]) -> None:
        """Puts the best window of each item into ``out``, the first of equals; hits are places of shared shingles."""
        last, n = len(shingles) - self.n, min(self.n, len(shingles))
        if n < SIMILARITY * self.n:
            return
        steps = np.zeros(max(last, 0) + 2, np.int64)
        np.add.at(steps, np.clip(hits - n + 1, 0, len(steps) - 1), 1)
        np.add.at(steps, np.clip(hits + 1, 0, len(steps) - 1), -1)
        starts = np.flatnonzero(np.cumsum(steps[:-1]) > 0)
        for a in range(0, len(starts), ASKED):
            some = starts[a : a + ASKED]
            asked, held = self.table.near(fingerprints(shingles, some, n))
            for s, item in zip(some[asked].tolist(), held.tolist(), strict=True):
                value, (best, at, _) = similarity(shingles[s : s + n], self.flat[item]), out.get(self.ids[item], (0.0, 0, 0))
                if value >= SIMILARITY and (value, -s) > (best, -at):
                    out[self.ids[item]] = value, s, n + self.k - 1


class Index:
    """All items of a part by size, and which sizes have a shingle: sorted shingles with the sizes that each occurs in."""

    def __init__(self, items: list[tuple[int | None, str | None]]):
        held: dict[tuple[int, int], tuple[list, list]] = {}
        for item_id, text in items:
            for _, buf, _ in pieces([text]):
                words = word_hashes(buf, *spans(buf, ALNUM))
                if len(words):
                    k = min(K, len(words))
                    shingles = shingle_hashes(words, k)
                    ids, all_shingles = held.setdefault((k, len(shingles)), ([], []))
                    ids.append(item_id)
                    all_shingles.append(shingles)
        self.sizes = [Size(k, n, *x) for (k, n), x in sorted(held.items())]
        self.known: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for k in {s.k for s in self.sizes}:
            each = [(np.unique(s.flat), i) for i, s in enumerate(self.sizes) if s.k == k]
            flat, size = np.concatenate([x for x, _ in each]), np.repeat([i for _, i in each], [len(x) for x, _ in each])
            order = np.argsort(flat, kind="stable")
            values, first = np.unique(flat[order], return_index=True)
            self.known[k] = values, np.append(first, len(flat)), size[order]

    def found(self, k: int, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of shingles that items have, and where among the known ones."""
        values = self.known[k][0]
        at = np.minimum(np.searchsorted(values, shingles), len(values) - 1)
        hit = np.flatnonzero(values[at] == shingles)
        return hit, at[hit]

    def matches(self, k: int, shingles: np.ndarray, hits: np.ndarray, at: np.ndarray, out: dict) -> None:
        """The matches of one text, by way of each size that shares a shingle."""
        _, first, sizes = self.known[k]
        counts = np.diff(first)[at]
        size, place = sizes[_ranges(first[at], counts)], np.repeat(hits, counts)
        for i in np.unique(size).tolist():
            self.sizes[i].matches(shingles, place[size == i], out)


def _parts(items: DataFrame, part_bytes: int) -> Iterator[Index]:
    rows = items.select(F.col("item_id").cast("long"), "text").filter("text is not null")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(size / part_bytes))
    for i in range(n):
        part = rows if n == 1 else rows.filter(F.pmod(F.xxhash64("item_id"), F.lit(n)) == i)  # all texts of an id, so that its best match is one row
        yield Index([(r.item_id, r.text) for r in sorted(part.collect(), key=lambda r: (r.item_id is None, r.item_id, r.text))])


def _scan(texts: list[str | None], index: Index) -> Iterator[tuple[int, dict]]:
    for first, buf, begins in pieces(texts):
        starts, ends = spans(buf, ALNUM)
        words = word_hashes(buf, starts, ends)
        edge = np.searchsorted(starts, [*begins, len(buf) + 1])
        for k in index.known:  # texts without any shared shingle are passed over at once
            shingles = shingle_hashes(words, k)
            if len(shingles):
                hit, at = index.found(k, shingles)
                doc = np.searchsorted(edge, hit, "right") - 1
                for d in np.unique(doc).tolist():
                    found: dict = {}
                    a, b = int(edge[d]), int(edge[d + 1])
                    mine = np.flatnonzero((doc == d) & (hit <= b - k))
                    index.matches(k, shingles[a : max(a, b - k + 1)], hit[mine] - a, at[mine], found)
                    if found:
                        yield first + d, found


def find_matches(docs: DataFrame, items: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """A row for each document and item of which it holds a window; see SCHEMA."""
    out = None
    for index in _parts(items, part_bytes):

        def rows(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for batch in few_rows(batches):
                best: dict[tuple[int, int | None], tuple] = {}
                for i, found in _scan(batch.column(1).to_pylist(), index):
                    for item_id, x in found.items():
                        best[i, item_id] = max(best.get((i, item_id), (0.0, 0, 0)), x, key=lambda v: (v[0], -v[1]))
                ids = batch.column(0)
                columns = [[ids[i].as_py() for i, _ in best], [item for _, item in best], *([x[j] for x in best.values()] for j in range(3))]
                types = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[x.split()[0] for x in SCHEMA.split(", ")])

        part = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(rows, SCHEMA)
        out = part if out is None else out.unionByName(part)
    return out


def drop_contaminated(docs: DataFrame, items: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """The documents without a match, with the columns they had."""
    at = docs.columns.index("text")
    for index in _parts(items, part_bytes):

        def rows(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for batch in few_rows(batches):
                keep = np.ones(batch.num_rows, bool)
                keep[[i for i, _ in _scan(batch.column(at).to_pylist(), index)]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(rows, docs.schema)
    return docs


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
