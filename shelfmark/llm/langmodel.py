"""Language model scoring: a hashed maximum-entropy model with a class-factored softmax.

log10 P(word | history) = log10 P(class | history) + log10 P(word | class, history). Classes hold about equal shares of
the training tokens; the commonest words have classes of their own. Both factors are maximum-entropy models:

- P(class | history) has the previous word, the one before it (a skip feature) and both together as features, hashed into
  rows with a weight for each class, on top of the classes' frequencies;
- P(word | class, history) has a weight for each row of the previous word with each of ``COLUMNS`` hashed columns of the
  word, on top of the word's smoothed frequency within its class. It is normalised over all words of the class: words of one
  class and column share a weight, so a row's normalisers are one product with the columns' masses.

Weights are trained on all training tokens by distributed gradient updates from zero. What was observed is counted once. What
is expected is summed by tasks over the distinct histories (rows of the two previous words, with how often each occurs)
in each of ``ROUNDS`` updates; the words' expected counts follow from the counts of classes after each row alone. A step is the
gradient of the penalised log-likelihood over a bound of its curvature (expected counts), at a rate shared by the
features that are active together.

The model grows with the corpus: the number of rows is in proportion to the cube root of the training tokens (``GROWTH``; a
power of two), and so histories and pairs of a row and a column grow with its square; the words outside the head are all counted.
Tasks that add up what was observed are given ``TOKENS`` tokens for each weight, so that their sums stay below the input.

Words of all training texts are counted by hash. The most frequent words (at most ``HEAD``, a bounded table) are known to every
task; all others are met by a join on their hashes, after each text has counted its own. They are too rare each for a
hot key, and sums come back by document. They are one class, within which only frequencies count.

Base score: the sum over tokens of log10((c + 0.1) / (N + 0.1 (V + 1))); one end token follows each text's words.

Nulls and edges: a null text is empty, which is one end token; a row without doc_id is not held out; repeated rows give
repeated rows, and count as often in training; without training texts all counts are 0 and N = 0 (the base is 0.1/0.1 =
1 a token); an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import _sums
from shelfmark.llm._fit import held_out
from shelfmark.llm._session import deleted, table, written, written_at
from shelfmark.llm._text import NOT_WHITE, few_rows, mix, pieces, spans, word_hashes

FOLDS, HELD_OUT = 10, 0
SMOOTH = 0.1
#: Words that every task knows, classes, gradient updates, the weight of the prior.
HEAD, CLASSES, ROUNDS, PRIOR = 1 << 17, 32, 5, 1.0
#: Rows of a word for the cube root of the training tokens, and at least; rows of two words for each of these; columns.
GROWTH, LEAST_ROWS, PAIRS, COLUMNS = 4.5, 256, 4, 256
KINDS = 3
#: Updates of the words' weights, which take no pass over the data.
INNER_ROUNDS = 20
#: Training tokens for each weight that a task counts observations for.
TOKENS = 4
#: Tokens that are looked at together, distinct words or histories held in a task (twice as many while they are added up), and
#: histories whose scores are in memory at once. A worker is kept for other tasks and holds on to the most that it took.
BATCH, HELD, SCORES = 1 << 18, 1 << 18, 1 << 13
#: The end token's hash; words' hashes are of their bytes.
END = np.uint64(0x51AB5EED0E4D0001)


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index of the first text, hashes with an end after each text, where each text's tokens end)."""
    for first, buf, begins in pieces(x.as_py() for x in batch.column(column)):
        starts, ends = spans(buf, NOT_WHITE)
        edge = np.searchsorted(starts, [*begins[1:], len(buf) + 1])
        hashes = np.insert(word_hashes(buf, starts, ends), edge, END)
        yield first, hashes, edge + np.arange(1, len(edge) + 1)


def added_up(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and the sums of their counts."""
    keys, times = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    cut = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[cut], np.add.reduceat(times[order], cut)


def tallied(found: Iterable[tuple[np.ndarray, np.ndarray]], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Keys with their counts, of which the same key's are added up as far as ``HELD`` distinct ones go."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    n = 0

    def batches() -> Iterator[pa.RecordBatch]:
        keys, times = held[0]
        for a in range(0, len(keys), BATCH):
            yield pa.RecordBatch.from_arrays([pa.array(keys[a : a + BATCH].view(np.int64)), pa.array(times[a : a + BATCH])], names=names)

    for some in found:
        held.append(some)
        n += len(some[0])
        if n >= 2 * HELD:
            held[:] = [added_up(held)]
            n = len(held[0][0])
            if n >= HELD:
                yield from batches()
                held.clear()
                n = 0
    if held:
        held[:] = [added_up(held)]
        yield from batches()


def vocabulary(train: DataFrame) -> DataFrame:
    """word (its hash), c: each token of the training texts; counts are summed within a task first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (np.unique(hashes, return_counts=True) for batch in batches for _, hashes, _ in _texts(batch, 0))
        yield from tallied(found, ["word", "c"])

    return train.mapInArrow(count, "word long, c long").groupBy("word").agg(F.sum("c").alias("c"))


def most_frequent(vocab: DataFrame, most: int) -> DataFrame:
    """The words above a count that at most ``most`` words reach: by a histogram of a few hundred levels of counts."""
    level = F.floor(F.log2("c") * 16)
    counts = sorted(((r.level, r["count"]) for r in vocab.groupBy(level.alias("level")).count().collect()), reverse=True)
    lowest, held = math.inf, 0
    for at, n in counts:
        if held + n > most:
            break
        lowest, held = at, held + n
    return vocab.filter(level >= lowest) if held else vocab.limit(0)


def rows_for(tokens: int) -> int:
    """The number of rows of a word, a power of two."""
    return max(LEAST_ROWS, 1 << round(math.log2(GROWTH * max(1, tokens) ** (1 / 3))))


def row_type(size: int) -> type[np.unsignedinteger]:
    """What holds a row in the encoded texts."""
    return np.uint16 if size <= 1 << 16 else np.uint32


class Lexicon:
    """The head of the vocabulary: counts, classes and feature rows of its words, by hash."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, n: int, v: int):
        self.size = rows_for(n)
        order = np.argsort(words)
        self.words, self.counts, self.n, self.v = words[order], counts[order].astype(np.float64), n, v
        # Classes: by rank, each with about an equal share of all tokens; the last is for words outside the head.
        rank = np.argsort(np.argsort(-self.counts, kind="stable"), kind="stable")
        below = np.cumsum(np.sort(self.counts)[::-1])
        share = (below - np.sort(self.counts)[::-1] / 2) / max(1, n)
        by_rank = np.minimum(np.arange(len(rank)), (share * (CLASSES - 1)).astype(np.int64)) if len(rank) else rank
        by_rank = np.minimum(np.unique(by_rank, return_inverse=True)[1], CLASSES - 2) if len(rank) else rank
        self.classes = by_rank[rank].astype(np.uint8)
        self.rows = np.where(rank < self.size // 2, rank, self.hashed_rows(self.words)) if len(rank) else rank
        # The smoothed frequency of a word within its class; what isn't in the head shares the last class's rest.
        size = np.bincount(self.classes, minlength=CLASSES).astype(np.float64)
        total = np.bincount(self.classes, weights=self.counts, minlength=CLASSES)
        total[CLASSES - 1], size[CLASSES - 1] = n - self.counts.sum(), max(0, v - len(words)) + 1
        self.mass = total + SMOOTH * size
        self.log_in_class = np.log10(self.counts + SMOOTH) - np.log10(self.mass[self.classes]) if len(rank) else self.counts
        self.log_base = np.log10(self.counts + SMOOTH)
        # Of empty classes none is expected.
        self.class_log = np.where(self.mass > 0, np.log(np.where(self.mass > 0, self.mass, 1) / self.mass.sum()), -1e4).astype(np.float32)
        # How much of each class lies in each column.
        self.share = np.zeros((CLASSES, COLUMNS))
        if len(rank):
            np.add.at(self.share, (self.classes, columns(self.rows)), 10**self.log_in_class)

    def hashed_rows(self, words: np.ndarray) -> np.ndarray:
        return self.size // 2 + (mix(words) % np.uint64(self.size // 2)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each hash stands, and whether it is in the head."""
        if not len(self.words):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return at, self.words[at] == hashes


def encode(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """For each row its tokens as classes and feature rows, the head's sums, and its other words with counts."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches):
            n = batch.num_rows
            tokens, known = np.zeros(n, np.int64), np.zeros(n, np.int64)
            base, inner = np.zeros(n), np.zeros(n)
            classes, features, words, counts = ([None] * n for _ in range(4))
            for first, hashes, edge in _texts(batch, 2):
                at, head = lexicon.find(hashes)
                kind = np.where(head, lexicon.classes[at] if len(lexicon.classes) else 0, CLASSES - 1).astype(np.uint8)
                row = np.where(head, lexicon.rows[at] if len(lexicon.rows) else 0, lexicon.hashed_rows(hashes)).astype(row_type(lexicon.size))
                log_base = np.where(head, lexicon.log_base[at], 0) if len(lexicon.words) else np.zeros(len(at))
                log_inner = np.where(head, lexicon.log_in_class[at], 0) if len(lexicon.words) else np.zeros(len(at))
                for d, (a, b) in enumerate(zip([0, *edge[:-1]], edge, strict=True)):
                    i = first + d
                    tokens[i], known[i] = b - a, int(head[a:b].sum())
                    base[i], inner[i] = log_base[a:b].sum(), log_inner[a:b].sum()
                    classes[i], features[i] = kind[a:b].tobytes(), row[a:b].tobytes()
                    rest, times = np.unique(hashes[a:b][~head[a:b]], return_counts=True)
                    words[i], counts[i] = rest.view(np.int64), times.astype(np.int32)
            sizes = pa.array(np.cumsum([0, *map(len, words)]).astype(np.int32))
            flat = lambda parts, kind: np.concatenate(parts) if n else np.empty(0, kind)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(tokens), pa.array(known), pa.array(base), pa.array(inner), pa.array(classes, pa.binary()), pa.array(features, pa.binary()),
                    pa.ListArray.from_arrays(sizes, pa.array(flat(words, np.int64))), pa.ListArray.from_arrays(sizes, pa.array(flat(counts, np.int32))),
                ],
                names=[x.split()[0] for x in ENCODED.split(", ")],
            )

    return docs.mapInArrow(rows, ENCODED)


ENCODED = "doc_id long, held_out boolean, n_tokens long, known long, base double, inner double, classes binary, features binary, words array<long>, counts array<int>"


def columns(rows: np.ndarray) -> np.ndarray:
    """The column of a word with such a row; the commonest words have columns of their own."""
    half = COLUMNS // 2
    return np.where(rows < half, rows, half + rows % half)


def histories(features: np.ndarray, size: int) -> np.ndarray:
    """The history of each token of one text: the rows of the two words before it; before its first stands the last row."""
    one = np.append(size - 1, features[:-1]).astype(np.int64)
    return one * size + np.append(size - 1, one[:-1])


def feature_rows(history: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of the three features, which follow each other: the previous word, the one before it, both."""
    one, two = np.divmod(history, size)
    return one, size + two, 2 * size + (mix(history.astype(np.uint64)) % np.uint64(PAIRS * size)).astype(np.int64)


def _gathered(batch: pa.RecordBatch, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(text of each token, its class, its column, its history) for some texts at a time, a long one in parts."""
    held: list[tuple] = []
    tokens = 0
    for i, (c, f) in enumerate(zip(batch.column(0), batch.column(1), strict=True)):
        kinds, rows = np.frombuffer(c.as_buffer(), np.uint8), np.frombuffer(f.as_buffer(), row_type(size))
        before, column = histories(rows, size), columns(rows)
        for a in range(0, len(kinds), BATCH):
            held.append((np.full(len(kinds[a : a + BATCH]), i, np.int32), *(x[a : a + BATCH] for x in (kinds, column, before))))
            tokens += len(held[-1][0])
            if tokens >= BATCH:
                yield tuple(map(np.concatenate, zip(*held, strict=True)))
                held, tokens = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*held, strict=True)))


def class_probabilities(weights: np.ndarray, bias: np.ndarray, history: np.ndarray, size: int) -> np.ndarray:
    """Softmax over classes for each history, in float32."""
    one, *others = feature_rows(history, size)
    scores = weights.take(one, axis=0)
    for rows in others:
        scores += weights.take(rows, axis=0)
    scores += bias
    scores -= scores.max(axis=1, keepdims=True)
    np.exp(scores, out=scores)
    scores /= scores.sum(axis=1, keepdims=True)
    return scores


def normalisers(inner: np.ndarray, share: np.ndarray) -> np.ndarray:
    """What the words of each class sum to after each row of the previous word; 1 where a class has no word of the head."""
    return np.where(share.sum(1) > 0, np.exp(inner) @ share.T, 1.0)


def observed_counts(encoded: DataFrame, size: int, tokens: int) -> tuple[np.ndarray, np.ndarray]:
    """How often each feature stood before each class, and each row of the previous word before each column of the head."""
    classes, inner = (2 + PAIRS) * size * CLASSES, size * COLUMNS

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(classes + inner), 0
        for batch in batches:
            for _, kinds, column, before in _gathered(batch, size):
                n += len(kinds)
                rows = feature_rows(before, size)
                for r in rows:
                    at, times = np.unique(r * CLASSES + kinds, return_counts=True)
                    total[at] += times
                head = kinds < CLASSES - 1
                at, times = np.unique(rows[0][head] * COLUMNS + column[head], return_counts=True)
                total[classes + at] += times
        if n:
            yield _sums.batch(total)

    tasks = max(1, math.ceil(tokens / (TOKENS * (classes + inner))))
    total = _sums.added(encoded.select("classes", "features").coalesce(tasks).mapInArrow(sums, _sums.SCHEMA), classes + inner)
    return total[:classes].reshape(-1, CLASSES), total[classes:].reshape(size, COLUMNS)


def history_counts(encoded: DataFrame, size: int) -> DataFrame:
    """history, n: how often each history occurs; counted within a task first, as far as it holds them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (np.unique(before, return_counts=True) for batch in batches for *_, before in _gathered(batch, size))
        yield from tallied(found, ["history", "n"])

    return encoded.select("classes", "features").mapInArrow(count, "history long, n long").groupBy("history").agg(F.sum("n").alias("n"))


def expected_counts(counted: DataFrame, weights: np.ndarray, bias: np.ndarray, size: int) -> np.ndarray:
    """How often the model expects each class after each feature."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros(weights.shape), 0
        for batch in batches:
            history, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for a in range(0, len(history), SCORES):
                own = history[a : a + SCORES]
                p = class_probabilities(weights, bias, own, size) * n[a : a + SCORES, None]
                some += len(own)
                for rows in feature_rows(own, size):
                    order = np.argsort(rows, kind="stable")
                    ranked = rows[order]
                    cut = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
                    total[ranked[cut]] += np.add.reduceat(p[order], cut, axis=0)
        if some:
            yield _sums.batch(total)

    return _sums.added(counted.mapInArrow(sums, _sums.SCHEMA), weights.size).reshape(weights.shape)


def update(weights: np.ndarray, observed: np.ndarray, expected: np.ndarray, rate: float) -> np.ndarray:
    """Weights after one step up the penalised log-likelihood."""
    gradient = observed - expected - PRIOR * weights
    return weights + np.clip(rate * gradient / (expected + PRIOR), -0.7, 0.7).astype(weights.dtype)


def train_inner(observed: np.ndarray, after: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Weights of columns after each row; after holds how often each class of the head stood after each row."""
    inner = np.zeros(observed.shape)
    for _ in range(INNER_ROUNDS):
        expected = np.exp(inner) * ((after / normalisers(inner, share)) @ share)
        inner = update(inner, observed, expected, 1.0)
    return inner


def train(encoded: DataFrame, lexicon: Lexicon, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Weights of classes after each feature, and of columns after each row of the previous word."""
    size = lexicon.size
    observed, columns_seen = observed_counts(encoded, size, lexicon.n)
    counted, at = written_at(history_counts(encoded, size), "histories")
    weights = np.zeros(observed.shape, np.float32)
    for _ in range(rounds):
        weights = update(weights, observed, expected_counts(counted, weights, lexicon.class_log, size), 1 / KINDS)
    deleted(at)
    after = np.where(np.arange(CLASSES) < CLASSES - 1, observed[:size], 0)
    return weights, train_inner(columns_seen, after, lexicon.share)


def token_logs(lexicon: Lexicon, weights: np.ndarray, inner: np.ndarray, norm: np.ndarray, kinds: np.ndarray, column: np.ndarray, before: np.ndarray) -> np.ndarray:
    """log10 of P(class | history) P(word | class, history) over the word's frequency in its class, for each token."""
    found, at = np.unique(before, return_inverse=True)
    logs = np.empty(len(before))
    order = np.argsort(at, kind="stable")
    edges = np.searchsorted(at[order], np.arange(0, len(found) + SCORES, SCORES))
    for i, a in enumerate(range(0, len(found), SCORES)):
        own = order[edges[i] : edges[i + 1]]
        p = class_probabilities(weights, lexicon.class_log, found[a : a + SCORES], lexicon.size)
        logs[own] = np.log10(np.maximum(p[at[own] - a, kinds[own]], 1e-30))
    one = before // lexicon.size
    return logs + np.where(kinds < CLASSES - 1, (inner[one, column] - np.log(norm[one, kinds])) / math.log(10), 0)


def fit(rows: DataFrame, head: int = HEAD, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame, Lexicon, np.ndarray, np.ndarray]:
    """The vocabulary of the rows (held_out, text and doc_id) that are not held out, all rows encoded, and the model."""
    vocab = written(vocabulary(rows.filter("not held_out").select("text")), "vocabulary")
    n, v = vocab.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    top = most_frequent(vocab, head).toArrow()
    lexicon = Lexicon(top["word"].to_numpy().view(np.uint64), top["c"].to_numpy(), n, v)
    encoded = written(encode(rows, lexicon).withColumn("row", F.monotonically_increasing_id()), "encoded")
    return vocab, encoded, lexicon, *train(encoded.filter("not held_out"), lexicon, rounds)


def score_texts(docs: DataFrame, head: int = HEAD, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each row."""
    rows = docs.select(F.col("doc_id").cast("long"), held_out(FOLDS, HELD_OUT).alias("held_out"), "text")
    vocab, encoded, lexicon, weights, inner = fit(rows, head, rounds)
    n, v, norm = lexicon.n, lexicon.v, normalisers(inner, lexicon.share)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = np.zeros(batch.num_rows)
            for text, kinds, column, before in _gathered(batch, lexicon.size):
                total += np.bincount(text, weights=token_logs(lexicon, weights, inner, norm, kinds, column, before), minlength=len(total))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(2, batch.num_columns)), pa.array(total)], names=[*batch.schema.names[2:], "class_score"])

    kept = ("row", "doc_id", "held_out", "n_tokens", "known", "base", "inner")
    scored = encoded.select("classes", "features", *kept).mapInArrow(score, "row long, doc_id long, held_out boolean, n_tokens long, known long, base double, inner double, class_score double")

    # Words outside the head, by their hashes; those that are in no training text have no row and count 0.
    rest = encoded.select("row", F.explode(F.arrays_zip("words", "counts")).alias("x")).select("row", F.col("x.words").alias("word"), F.col("x.counts").alias("times"))
    met = rest.join(vocab, "word", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    sums = met.groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("known_rest"),
        F.sum(F.col("times") * F.log10(F.col("c") + SMOOTH)).alias("log_rest"),
        F.sum("times").alias("n_rest"),
    )
    whole = scored.join(sums, "row", "left").fillna(0, ["known_rest", "log_rest", "n_rest"])
    base = F.col("base") + F.col("log_rest") - F.col("n_tokens") * math.log10(n + SMOOTH * (v + 1))
    model = F.col("class_score") + F.col("inner") + F.col("log_rest") - F.col("n_rest") * math.log10(lexicon.mass[CLASSES - 1])
    return whole.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.col("known_rest")).cast("long").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"), base.alias("base_score"), model.alias("score")
    )


def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))
