"""N-gram Jaccard join with vertical partitioning.

The order of all n-grams is cut into fragments (ranges of their hashes). Each text becomes one short run of n-grams in
each fragment, and every fragment is worked on by itself:

1. Within a fragment, n-grams are counted; those of one text only are dropped there, as they add nothing to any
   overlap. What leaves the fragment is small. A text of whose n-grams fewer than the threshold are shared at all has
   no partner and leaves too.
2. Prefix: by document frequency, rarest first, a text of n n-grams must share one of its first n - ceil(t n) + 1 with
   any partner; the rank of a shared n-gram counts the text's unshared ones before it. So only texts made mostly of
   shared n-grams post anything.
3. Verification: a pair's partial overlaps are counted fragment by fragment and summed.

Components need no more links than connect them. So each posting list first meets one centre (the member with the
largest share of shared n-grams); after the links found, only lists with several components remain, and in those only
members outside the list's largest component meet the others, under the length filter (by classes of lengths, of which
only neighbours meet) and the positional filter for both. Every pair of texts that can reach the threshold and isn't
connected yet is verified: no link between components is lost, and a large group of copies costs a number of pairs in
proportion to its size. Equal texts are one text from the start.

All links lie within components. They are counted there, for each text the number of other texts that it links to:
a component's texts are cut into blocks of about ``CELL``, and a task multiplies the incidence matrices of two blocks, so that
every overlap within the component is known without a row for any pair.

Skew: n-grams of very many texts would make their fragment's task long. They are found beforehand by a sketch (counts of
hash cells over all texts, of a size that the corpus gives up to ``CELLS``): what lies in a cell of at least ``HOT`` counts,
and of ``OVER`` times the mean, skips the fragments and goes straight to its texts, with the cell's count as its frequency.
The order stays one order for all texts, so results don't depend on it. Sums and centres are aggregated before shuffles; keys
with many rows (a text with many copies, a list or a centre with many members) are salted in joins.

Hashes: texts are told apart by 64 bits of a hash, n-grams by their fragment and ``BITS`` bits of theirs (five bytes). Of N
texts two different ones are taken for one with a probability of about N^2 / 2^65; two n-grams of a pair of texts with n
n-grams each agree by chance with about n^2 / (2^40 fragments), which matters only for pairs just below the threshold.

Nulls and edges: a text without words has no n-gram, size 0 and links to nothing; one with fewer words than k is one
n-gram; a row without doc_id takes part in links, but gives no name to a component (null if none of its rows has one);
repeated rows give repeated rows of the result; a long text is cut into n-grams whole; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import _sums
from shelfmark.llm._session import deleted, table, written, written_at
from shelfmark.llm._text import NOT_WHITE, few_rows, mix, shingle_sets

#: Fragments hold about so many n-grams.
FRAGMENT = 3_000_000
#: N-grams are compared by the number of their fragment and so many bits of their hash.
BITS = 40
#: Verification counts partial overlaps in so many groups of fragments.
GROUPS = 8
#: Cells of the sketch at most, n-grams a cell on average below that; from which counts on an n-gram is hot.
CELLS, PER_CELL = 1 << 22, 512
HOT, OVER = 20_000, 16
#: Texts in a block of a component; bytes of n-grams of small components that one task gets, on average.
CELL, CELL_BYTES = 256, 1 << 24
#: Keys with more rows are dealt in shares of half of it: the SPLIT_KEYS longest, so that what is broadcast is bounded.
SPLIT, SPLIT_KEYS = 1000, 1000
#: Tables of up to so many rows of a few numbers are sent to all tasks, longer ones are shuffled; fragments at least.
BROADCAST_ROWS = 1_000_000
FRAGMENTS = 32


def least_shared(percent: int) -> str:
    """SQL: what a set of n must share with any partner; also the least size of a partner."""
    return f"(n * {percent} + 99) div 100"


def overlap(percent: int, n: str, m: str) -> str:
    """SQL: what sets of n and m must share."""
    return f"((({n}) + ({m})) * {percent} + {99 + percent}) div {100 + percent}"


def can_meet(percent: int) -> str:
    """SQL: the length filter for a and b, and the positional one for the first n-gram that they share."""
    o = overlap(percent, "a_n", "b_n")
    return f"least(a_n, b_n) * 100 >= greatest(a_n, b_n) * {percent} and a_pos <= a_n - {o} + 1 and b_pos <= b_n - {o} + 1"


def node_of() -> Column:
    """What tells texts apart; a null text is empty."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def long_keys(rows: DataFrame, key: str) -> list[tuple[int, int]]:
    """(key, in how many shares its rows are dealt) of the keys with many rows, SPLIT_KEYS at most."""
    counts = rows.groupBy(key).count().filter(F.col("count") > SPLIT).orderBy(F.desc("count"), key).limit(SPLIT_KEYS)
    return [(r[0], math.ceil(r[1] / (SPLIT // 2))) for r in counts.collect()]


def counted(rows: DataFrame) -> DataFrame:
    """A written table of few columns, marked for broadcasting if it has few enough rows."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def salted_join(many: DataFrame, one: DataFrame, key: str, shares: list[tuple[int, int]], also: tuple[str, ...] = (), how: str = "inner") -> DataFrame:
    """Joins rows by a key (and also columns) with the rows of few for each key; long keys' rows are dealt in shares."""
    if not shares:
        return many.join(one, [key, *also], how)
    held = F.broadcast(many.sparkSession.createDataFrame(shares, f"{key} long, _shares int"))
    n = F.coalesce("_shares", F.lit(1))
    dealt = many.join(held, key, "left").withColumn("_share", F.pmod(F.xxhash64(F.monotonically_increasing_id()), n).cast("int")).drop("_shares")
    copied = one.join(held, key, "left").withColumn("_share", F.explode(F.sequence(F.lit(0), n - 1))).drop("_shares")
    return dealt.join(copied, [key, "_share", *also], how).drop("_share")


def cells_of(grams: np.ndarray, cells: int) -> np.ndarray:
    """The sketch's cell of each hash, made of bits that are kept of it."""
    return ((grams >> np.uint64(8)) & np.uint64(cells - 1)).astype(np.int64)


def measured(docs: DataFrame, k: int, cells: int) -> DataFrame:
    """(doc_id, node, n) for each row: its text and the size of its set; and, in rows with a block instead, the tasks'
    sketches."""
    schema = f"doc_id long, node long, n long, {_sums.SCHEMA}"

    def size(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in schema.split(", ")]
        total, seen = np.zeros(cells), 0
        for batch in few_rows(batches):
            n = []
            for s in shingle_sets(batch.column(2).to_pylist(), k, NOT_WHITE):
                n.append(len(s))
                np.add.at(total, cells_of(s, cells), 1)
            seen += sum(n)
            none = [pa.nulls(len(n), t) for t in (pa.int32(), pa.int32(), pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), *none], names=names)
        if seen:
            at, group, part = _sums.blocks(total)
            none = [pa.nulls(len(at), t) for t in (pa.int64(), pa.int64(), pa.int64())]
            yield pa.RecordBatch.from_arrays([*none, pa.array(at, pa.int32()), pa.array(group, pa.int32()), pa.array(part, pa.binary())], names=names)

    return docs.select(F.col("doc_id").cast("long"), node_of().alias("node"), "text").mapInArrow(size, schema)


def hot_cells(measures: DataFrame, cells: int, hot: int) -> np.ndarray:
    """The count of each cell that is hot, 0 of any other."""
    total = _sums.added(measures.filter("block is not null").select("block", "grp", "part"), cells)
    return np.where(total >= max(hot, OVER * total.mean()), total, 0).astype(np.uint32)


RUNS = "frag int, hot boolean, nodes binary, counts binary, grams binary, tops binary, frags binary, dfs binary"


def fragments(texts: DataFrame, k: int, n_fragments: int, hot: np.ndarray) -> DataFrame:
    """The runs of several texts in a fragment, one after the other; hot n-grams with their counts, by buckets of texts
    (numbered after the fragments). A task takes equal texts once; those of different tasks are told by their node.

    counts are the runs' lengths; a hash's bits are packed as four bytes and a fifth.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            fresh = [i for i, node in enumerate(batch.column(0).to_pylist()) if not (node in seen or seen.add(node))]
            for at in range(0, len(fresh), 2000):
                part = batch.take(pa.array(fresh[at : at + 2000], pa.int64()))
                nodes = part.column(0).to_numpy()
                sets = list(shingle_sets(part.column(1).to_pylist(), k, NOT_WHITE))
                sizes = np.array([len(s) for s in sets], np.int32)
                flat = np.concatenate(sets)
                del sets
                owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
                frag = ((flat >> np.uint64(32)) * np.uint64(n_fragments) >> np.uint64(32)).astype(np.int32)
                df = hot[cells_of(flat, len(hot))]
                place = np.where(df > 0, n_fragments + _scattered(nodes, n_fragments)[owner], frag)
                order = np.argsort(place, kind="stable")  # by fragment or bucket, then text
                flat, owner, frag, df = flat[order], owner[order], frag[order], df[order]
                bounds = np.searchsorted(place[order], np.arange(2 * n_fragments + 1))
                grams, tops = flat.astype(np.uint32), (flat >> np.uint64(32)).astype(np.uint8)
                out: list[tuple] = []
                for f in np.flatnonzero(np.diff(bounds)).tolist():
                    a, b = bounds[f], bounds[f + 1]
                    own, counts = np.unique(owner[a:b], return_counts=True)
                    more = (frag[a:b], df[a:b]) if f >= n_fragments else (frag[:0], df[:0])
                    out.append((f, f >= n_fragments, *(x.tobytes() for x in (nodes[own], counts.astype(np.int32), grams[a:b], tops[a:b], *more))))
                columns = list(zip(*out, strict=True)) or [[]] * 8
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.bool_()), *(pa.array(c, pa.binary()) for c in columns[2:])], names=[x.split()[0] for x in RUNS.split(", ")])

    return texts.mapInArrow(cut, RUNS)


def _scattered(nodes: np.ndarray, n: int) -> np.ndarray:
    """A number below n for each node."""
    return (mix(nodes.view(np.uint64)) % np.uint64(n)).astype(np.int32)


def _joined(held: pa.Table, name: str, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(held[name].to_pylist()), kind)


def shared_grams(runs: DataFrame, n_fragments: int) -> DataFrame:
    """As in fragments, but by buckets of texts (as many as fragments), and only n-grams that another text has too, with
    the number of texts that have them."""

    def count(held: pa.Table) -> pa.Table:
        place = held["frag"][0].as_py()
        if place >= n_fragments:
            return held.set_column(0, "bucket", pa.array(np.full(len(held), place - n_fragments, np.int32)))
        counts, bottoms, tops = _joined(held, "counts", np.int32), _joined(held, "grams", np.uint32), _joined(held, "tops", np.uint8)
        nodes = _joined(held, "nodes", np.int64)
        once = np.zeros(len(nodes), bool)
        once[np.unique(nodes, return_index=True)[1]] = True
        mine = np.repeat(once, counts)
        counts, bottoms, tops, nodes = counts[once], bottoms[mine], tops[mine], nodes[once]
        grams = (tops.astype(np.int64) << 32) | bottoms
        order = np.argsort(grams, kind="stable")
        ranked = grams[order]
        df = np.diff(np.append(np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])), len(ranked)))
        of = np.empty(len(grams), np.uint32)
        of[order] = np.repeat(df, df)
        owner = np.repeat(np.arange(len(counts)), counts)
        keep = np.flatnonzero(of > 1)
        bucket = _scattered(nodes, n_fragments)
        keep = keep[np.argsort(bucket[owner[keep]], kind="stable")]
        cut = np.searchsorted(bucket[owner[keep]], np.arange(n_fragments + 1))
        out: list[tuple] = []
        for i in range(n_fragments):
            some = keep[cut[i] : cut[i + 1]]
            if len(some):
                own, n = np.unique(owner[some], return_counts=True)
                frags = np.full(len(some), place, np.int32)
                out.append((i, False, *(x.tobytes() for x in (nodes[own], n.astype(np.int32), bottoms[some], tops[some], frags, of[some]))))
        columns = list(zip(*out, strict=True)) or [[]] * 8
        return pa.table([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.bool_()), *(pa.array(c, pa.binary()) for c in columns[2:])], names=[x.split()[0] for x in SHARED.split(", ")])

    return runs.groupBy("frag").applyInArrow(count, SHARED)


SHARED = RUNS.replace("frag int", "bucket int")
TEXTS = "node long, n long, own long, prefix array<long>, parts array<array<long>>"


def sizes_of(texts: DataFrame, n_fragments: int) -> DataFrame:
    """The sizes of all texts' sets by the buckets of shared_grams: rows without hot, with sizes in place of counts."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, n = batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(np.int32)
            bucket = _scattered(nodes, n_fragments)
            order = np.argsort(bucket, kind="stable")
            places, first = np.unique(bucket[order], return_index=True)
            parts = [(nodes[x].tobytes(), n[x].tobytes()) for x in np.split(order, first[1:])] if len(order) else []
            columns = [pa.array(places, pa.int32()), pa.nulls(len(parts), pa.bool_()), *(pa.array([x[i] for x in parts], pa.binary()) for i in range(2)), *[pa.array([b""] * len(parts), pa.binary())] * 4]
            yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in SHARED.split(", ")])

    return texts.select("node", "n").mapInArrow(deal, SHARED)


def sharing_texts(shared: DataFrame, percent: int, n_fragments: int) -> DataFrame:
    """The texts that share enough n-grams to have a partner: how many they share (own of n), which of these stand in their
    prefix, rarest first, and all of them by groups of fragments. shared holds the rows of sizes_of too."""

    def gather(held: pa.Table) -> pa.Table:
        is_size = held["hot"].is_null()
        sized, held = held.filter(is_size), held.filter(pc.invert(is_size))
        known, sizes = _joined(sized, "nodes", np.int64), _joined(sized, "counts", np.int32)
        counts, nodes = _joined(held, "counts", np.int32), _joined(held, "nodes", np.int64)
        frag = _joined(held, "frags", np.int32).astype(np.int64)
        grams = (frag << BITS) | (_joined(held, "tops", np.uint8).astype(np.int64) << 32) | _joined(held, "grams", np.uint32)
        dfs = _joined(held, "dfs", np.uint32)
        # The hot n-grams of a text come from each task that has it.
        hot = np.repeat(held["hot"].to_numpy(), [len(x) // 8 for x in held["nodes"].to_pylist()])
        once = ~hot
        once[np.flatnonzero(hot)[np.unique(nodes[hot], return_index=True)[1]]] = True
        mine = np.repeat(once, counts)
        counts, nodes, frag, grams, dfs = counts[once], nodes[once], frag[mine], grams[mine], dfs[mine]
        names, text = np.unique(nodes, return_inverse=True)
        order = np.argsort(known)
        n = sizes[order[np.searchsorted(known[order], names)]].astype(np.int64) if len(names) else np.empty(0, np.int64)
        text = np.repeat(text, counts)
        own = np.bincount(text, minlength=len(names))
        least = (n * percent + 99) // 100
        alive = np.flatnonzero(own >= least)
        number = np.full(len(names), -1)
        number[alive] = np.arange(len(alive))
        mine = np.flatnonzero(number[text] >= 0)
        text, grams, dfs, frag = number[text[mine]], grams[mine], dfs[mine], frag[mine]
        own, n, take = own[alive], n[alive], (own - least + 1)[alive]

        rare = np.lexsort((grams, dfs, text))
        place = np.arange(len(rare)) - np.repeat(np.cumsum(own) - own, own)
        first = rare[place < take[text[rare]]]
        prefix = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(take)).astype(np.int32)), pa.array(grams[first]))
        cell = text * GROUPS + frag * GROUPS // n_fragments
        inner = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(np.bincount(cell, minlength=len(alive) * GROUPS))).astype(np.int32)), pa.array(grams[np.argsort(cell, kind="stable")]))
        parts = pa.ListArray.from_arrays(pa.array((np.arange(len(alive) + 1) * GROUPS).astype(np.int32)), inner)
        return pa.table([pa.array(names[alive]), pa.array(n), pa.array(own), prefix, parts], names=[x.split()[0] for x in TEXTS.split(", ")])

    return shared.groupBy("bucket").applyInArrow(gather, TEXTS)


def verify(pairs: DataFrame, segments: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b, a_n, b_n) that link: partial overlaps are counted in each group of fragments."""
    left = segments.select(F.col("node").alias("a"), "part", F.col("grams").alias("a_grams"))
    few = counted(pairs)
    centres = segments.join(few.select(F.col("b").alias("node")), "node", "left_semi")
    right = centres.select(F.col("node").alias("b"), "part", F.col("grams").alias("b_grams"))
    met = salted_join(few.join(left, "a"), right, "b", long_keys(pairs, "b"), also=("part",))
    partial = met.select("a", "b", "a_n", "b_n", F.size(F.array_intersect("a_grams", "b_grams")).cast("long").alias("shared"))
    summed = partial.groupBy("a", "b", "a_n", "b_n").agg(F.sum("shared").alias("shared"))
    return summed.filter(f"shared * 100 >= (a_n + b_n - shared) * {percent}").select("a", "b")


def components(links: DataFrame, texts: DataFrame) -> DataFrame:
    """node, name: of each linked node the smallest name (no id last, id, node) of those that it reaches.

    Rounds of the smallest name among neighbours, then of that name's own; each round's table is written, and the one
    before deleted. Minima are taken before the shuffle, so a node with many links is no single task's work.
    """
    both = written(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    shares = long_keys(both, "b")
    labels, at = written_at(both.select(F.col("a").alias("node")).distinct().join(texts, "node").select("node", name_of().alias("name")), "labels")
    while True:
        near = salted_join(both, labels.select(F.col("node").alias("b"), "name"), "b", shares).groupBy("a").agg(F.min("name").alias("near"))
        lower = labels.join(near.withColumnRenamed("a", "node"), "node").select("node", F.least("name", "near").alias("name"), F.col("name").alias("was"))
        lower, lower_at = written_at(lower.withColumn("to", F.col("name.node")), "labels")
        own = lower.select(F.col("node").alias("to"), F.col("name").alias("deeper"))
        jumped = salted_join(lower, own, "to", long_keys(lower, "to")).select("node", F.least("name", "deeper").alias("name"), "was")
        now, now_at = written_at(jumped, "labels")
        deleted(at)
        deleted(lower_at)
        if not now.filter("name <> was").limit(1).count():
            return now.select("node", "name")
        labels, at = now.select("node", "name"), now_at


def name_of() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("node").alias("node"))


def link_texts(docs: DataFrame, texts: DataFrame, k: int, percent: int, n_fragments: int, hot: np.ndarray, counts: bool = True) -> DataFrame:
    """node, name and, with counts, n_links of every distinct text that links to another."""
    least = least_shared(percent)
    shared = shared_grams(fragments(docs.select(node_of().alias("node"), "text"), k, n_fragments, hot), n_fragments)
    sharing, at = written_at(sharing_texts(shared.unionByName(sizes_of(texts, n_fragments)), percent, n_fragments), "sharing-texts")
    segments = sharing.select("node", F.posexplode("parts").alias("part", "grams")).filter("size(grams) > 0")
    posts = sharing.select("node", "n", "own", F.posexplode("prefix").alias("at", "gram"))
    posts = posts.select("gram", "node", "n", F.expr("n - own + at + 1").alias("pos"), (F.col("own") / F.col("n")).alias("share"))

    # One centre for each list.
    shares = long_keys(posts, "gram")
    centre = posts.groupBy("gram").agg(F.max(F.struct("share", "node", "n", "pos")).alias("c"), F.count("*").alias("df")).filter("df > 1")
    star = salted_join(posts, centre, "gram", shares).select(F.col("node").alias("a"), F.col("n").alias("a_n"), F.col("c.node").alias("b"), F.col("c.n").alias("b_n"))
    star, star_at = written_at(star.filter(f"a <> b and least(a_n, b_n) * 100 >= greatest(a_n, b_n) * {percent}").distinct(), "star")
    links = written(verify(star, segments, percent), "links")
    comps = components(links, texts)

    # Lists with several components left.
    named = posts.join(counted(comps.select("node", F.col("name.node").alias("comp"))), "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    sizes = named.groupBy("gram", "comp").agg(F.count("*").alias("members"), F.min("n").alias("low"))
    mixed = sizes.groupBy("gram").agg(F.max(F.struct("members", "comp")).alias("big"), F.count("*").alias("comps"), F.min("low").alias("low")).filter("comps > 1")
    near = salted_join(named, mixed.select("gram", F.col("big.comp").alias("big"), "low"), "gram", shares)
    width = max(math.log(100 / percent) * 1.0001, 1e-9)
    near = near.filter(f"pos <= n - {overlap(percent, 'n', f'greatest(low, {least})')} + 1").withColumn("size_class", F.floor(F.log("n") / width))
    near, near_at = written_at(near, "open-postings")
    one, two = (near.select("gram", "big", "size_class", *(F.col(c).alias(f"{p}_{c}" if c != "node" else p) for c in ("node", "n", "pos", "comp"))) for p in "ab")
    two = two.drop("big").withColumn("size_class", F.explode(F.array(*(F.col("size_class") + i for i in (-1, 0, 1)))))
    open_pairs = one.filter("a_comp <> big").join(two, ["gram", "size_class"]).filter(f"a_comp <> b_comp and (b_comp = big or a < b) and {can_meet(percent)}")
    more = written(verify(written(open_pairs.select("a", "b", "a_n", "b_n").distinct(), "open-pairs"), segments, percent), "more-links")
    if more.limit(1).count():
        comps = components(links.unionByName(more), texts)
    found = written(comps.join(count_links(sharing, comps, percent), "node"), "components") if counts else comps
    for path in (at, star_at, near_at):
        deleted(path)
    return found


def count_links(sharing: DataFrame, comps: DataFrame, percent: int) -> DataFrame:
    """node, n_links: to how many other texts each links, by blocks of its component (see CELL)."""
    held = comps.select("node", F.col("name.node").alias("comp"))
    sizes = held.groupBy("comp").agg(F.count("*").alias("members"))
    texts = salted_join(held, sizes, "comp", long_keys(held, "comp"))
    texts = counted(written(texts, "members-of-components")).join(sharing.select("node", "n", F.flatten("parts").alias("grams")), "node")
    total = texts.agg(F.coalesce(F.sum(F.size("grams")), F.lit(0))).first()[0]
    buckets = max(1, math.ceil(8 * total / CELL_BYTES))
    n_blocks = F.ceil(F.col("members") / CELL).cast("int")
    texts = texts.withColumn("own", F.pmod(F.xxhash64("node"), n_blocks).cast("int")).withColumn("n_blocks", n_blocks)
    texts = texts.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    texts = texts.withColumn("place", F.when(F.col("n_blocks") > 1, F.col("comp")).otherwise(F.pmod(F.xxhash64("comp"), F.lit(buckets))))
    cells = texts.select("place", "n_blocks", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "comp", "node", "n", "grams")

    def count(cell: pa.Table) -> pa.Table:
        comp, own, nodes, n = (cell[c].to_numpy() for c in ("comp", "own", "node", "n"))
        grams = cell["grams"].combine_chunks()
        starts, flat = grams.offsets.to_numpy(), grams.flatten().to_numpy()
        starts = starts - starts[0]
        across = cell["i"][0].as_py() != cell["j"][0].as_py()
        links, order = np.zeros(len(nodes), np.int64), np.argsort(comp, kind="stable")
        for mine in np.split(order, np.flatnonzero(np.diff(comp[order])) + 1):
            same = _overlaps([flat[starts[r] : starts[r + 1]] for r in mine])
            linked = same * 100 >= (n[mine, None] + n[None, mine] - same) * percent
            linked &= (own[mine, None] != own[None, mine]) if across else ~np.eye(len(mine), dtype=bool)
            links[mine] = linked.sum(1)
        return pa.table({"node": pa.array(nodes), "n_links": pa.array(links)})

    partial = cells.groupBy("place", "n_blocks", "i", "j").applyInArrow(count, "node long, n_links long")
    return partial.groupBy("node").agg(F.sum("n_links").alias("n_links"))


def _overlaps(sets: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """How many elements each two of the sets share: products of their incidence matrices, some columns at a time."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times > 1
    owner, column = owner[shared[column]], (np.cumsum(shared) - 1)[column[shared[column]]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(sets), len(sets)), np.int64)
    for a in range(0, int(shared.sum()), width):
        low, high = np.searchsorted(column, [a, a + width])
        some = np.zeros((len(sets), min(width, int(shared.sum()) - a)), np.float32)
        some[owner[low:high], column[low:high] - a] = 1
        out += (some @ some.T).astype(np.int64)
    return out


def members(docs: DataFrame, k: int, percent: int, hot: int, counts: bool = True) -> tuple[DataFrame, DataFrame]:
    """(doc_id, node, n) for each row; (node, doc_id, n, name and, with counts, n_links) for each distinct text: its smallest id, the
    size of its set, its component's name, and how many other texts it links to."""
    grams = (docs.agg(F.sum(F.length("text"))).first()[0] or 0) // 5
    cells = min(CELLS, max(1 << 12, 1 << (grams // PER_CELL).bit_length()))
    measures = written(measured(docs, k, cells), "measured")
    rows = measures.filter("block is null").select("doc_id", "node", "n")
    texts = written(rows.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n")), "texts")
    found = link_texts(docs, texts, k, percent, max(FRAGMENTS, math.ceil(grams / FRAGMENT)), hot_cells(measures, cells, hot), counts)
    whole = texts.join(found, "node", "left").withColumn("name", F.coalesce("name", name_of()))
    return rows, whole.withColumn("n_links", F.coalesce("n_links", F.lit(0).cast("long"))) if counts else whole


def jaccard_components(docs: DataFrame, k: int = 5, percent: int = 80, hot: int = HOT) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links for each row; n_links is the number of other distinct texts that its text
    links to (its copies are in the component, not counted)."""
    rows, texts = members(docs, k, percent, hot)
    named = texts.select("node", F.when(~F.col("name.none"), F.col("name.id")).alias("component_id"), "n_links")
    joined = salted_join(rows, named, "node", long_keys(rows, "node"))
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), "n_links")


def drop_near_copies(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component, with the columns it had: the one with the smallest id, of rows with one id or none
    the one with the smallest hash of its text, and of those that are equal in both the one with the smallest hash of all its columns
    (but maps), whatever their order. Rows of one id in different components all stay. Texts without words are no copies of each
    other; they stay, one for each id and text."""
    key = ["_none", "_id", "_node"]  # no id comes last
    keyed = lambda node: (F.col("doc_id").isNull().alias("_none"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("_id"), node.alias("_node"))
    rows, texts = members(docs, k, percent, HOT, counts=False)  # who stays depends on components alone
    named = texts.filter("n > 0 and name.node = node").select(*keyed(F.col("node")))
    first = named.unionByName(rows.filter("n = 0").select(*keyed(F.col("node"))).distinct())
    own = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), *keyed(node_of()))  # apart from our columns
    plain = [F.col("_row").getField(f.name) for f in docs.schema if not any(x in f.dataType.simpleString() for x in ("map<", "variant"))]
    kept = own.join(first, key, "left_semi").groupBy(*key).agg(F.min_by("_row", F.xxhash64(*plain)).alias("_row"))
    return kept.select(*(F.col("_row").getField(c).alias(c) for c in docs.columns))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), k=4, percent=85)
