"""Quality classifier: Bradley-Terry pairwise ranking with a threshold at a score quantile.

A document's strength is linear in features of its text. Preference pairs (a document labelled 1 against one
labelled 0) give the logistic loss on feature differences that the weights minimise. The cut is the quantile of
the training scores that parts the labels best; scores are mapped so that ``CUT`` (0.3) stands at that quantile.

Fitting uses at most ``SAMPLE`` labelled rows (chosen by a hash of their ids) and ``PAIRS`` pairs for each of them;
what the driver gets is their features. Scoring is one scan with a weight vector; nothing is shuffled.

Nulls and edges: a null text is empty and is scored like one; without labels of both kinds every score is 0.5;
a null doc_id is passed on, not held out; repeated rows give repeated rows; of rows that repeat an id with other texts one is
fitted on, chosen by a hash of the text, and all are scored; a very long text is one row, its features are sums over it; scores that
tie at the cut are all above it; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm._fit import held_out, labelled_sample, logistic, sigmoid
from shelfmark.llm._session import table
from shelfmark.llm._text import NOT_WHITE, few_rows, mix, pieces, shingle_hashes, spans, word_hashes

#: At most so many labelled rows are fitted on, with so many pairs each.
SAMPLE, PAIRS = 20_000, 8
L2 = 1e-3
CUT = 0.3
FOLDS, HELD_OUT = 5, 0

FEATURES = (
    "empty", "log bytes", "log words", "capitals", "digits", "marks !?", "signs #$%&*", "bars and brackets", "stops .,;:",
    "line ends", "outside ASCII", "bytes a word", "distinct words", "most frequent word", "word repeated at once", "distinct triples", "distinct lines",
)


def _share(of: bytes) -> np.ndarray:
    out = np.zeros(256)
    out[list(of)] = 1
    return out


_SHARES = np.stack(
    [
        _share(bytes(range(65, 91))),
        _share(b"0123456789"),
        _share(b"!?"),
        _share(b"#$%&*@^~=+"),
        _share(b"|<>[]{}()_/\\"),
        _share(b".,;:"),
        _share(b"\n"),
        _share(bytes(range(128, 256))),
    ],
    axis=1,
)


def features(texts: list[str | None]) -> np.ndarray:
    """A row for each text, in the order of FEATURES."""
    out = np.zeros((len(texts), len(FEATURES)))
    for i, text in enumerate(texts):
        raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
        out[i, 3:11] = np.bincount(raw, minlength=256) @ _SHARES / max(1, len(raw))
        out[i, 1] = np.log1p(len(raw))
    for first, buf, begins in pieces(texts):
        starts, ends = spans(buf, NOT_WHITE)
        words = word_hashes(buf, starts, ends)
        triples = mix(shingle_hashes(words, 3))
        breaks = np.flatnonzero(np.frombuffer(buf, np.uint8) == 10)
        line_from, line_to = np.append(0, breaks + 1), np.append(breaks, len(buf))
        lines = _line_hashes(words, starts, line_from)
        edge = np.searchsorted(starts, [*begins, len(buf) + 1])
        line_edge = np.searchsorted(line_from, [*begins, len(buf) + 1])
        for d in range(len(begins)):
            a, b = int(edge[d]), int(edge[d + 1])
            if a == b:
                out[first + d, 0] = 1
                continue
            own, n = words[a:b], b - a
            _, counts = np.unique(own, return_counts=True)
            some = triples[a : max(a + 1, b - 2)] if n > 2 else own[:1]
            row = lines[line_edge[d] : line_edge[d + 1]]
            out[first + d, 2] = np.log1p(n)
            out[first + d, 11:] = (
                (ends[a:b] - starts[a:b]).mean() / 10,
                np.log(len(counts) / n),
                counts.max() / n,
                (own[1:] == own[:-1]).mean() if n > 1 else 0,
                len(np.unique(some)) / len(some),
                len(np.unique(row)) / len(row),
            )
    return out


def _line_hashes(words: np.ndarray, starts: np.ndarray, line_from: np.ndarray) -> np.ndarray:
    """A hash of each line's words in their order."""
    at = np.searchsorted(starts, line_from)
    place = np.arange(len(words), dtype=np.uint64) - np.repeat(at, np.diff(np.append(at, len(words)))).astype(np.uint64) if len(words) else words
    sums = np.append(np.uint64(0), np.cumsum(mix(words ^ mix(place + np.uint64(1))))) if len(words) else np.zeros(1, np.uint64)
    return sums[np.append(at[1:], len(words))] - sums[at]


def fit(x: np.ndarray, y: np.ndarray, pairs: int = PAIRS, seed: int = 7) -> dict[str, np.ndarray | float]:
    """Bradley-Terry weights, the cut and the slope of the score."""
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    mean, scale = x.mean(0) if len(x) else np.zeros(x.shape[1]), x.std(0) + 1e-6 if len(x) else np.ones(x.shape[1])
    if not len(good) or not len(bad):
        return {"mean": mean, "scale": scale, "w": np.zeros(x.shape[1]), "cut": 0.0, "slope": 0.0, "at": 0.5}
    z, rng = np.clip((x - mean) / scale, -8, 8), np.random.default_rng(seed)
    n = pairs * len(x) // 2
    diff = z[rng.choice(good, n)] - z[rng.choice(bad, n)]
    w = logistic(diff, np.ones(n), L2)
    s = z @ w
    # The quantile that parts the labels with the fewest errors; amid a gap of equal ones, the middle.
    order = np.argsort(s)
    wrong = np.append((y == 0).sum(), (y == 0).sum() + np.cumsum(np.where(y[order] == 1, 1, -1)))
    best = np.flatnonzero(wrong == wrong.min())
    level = best[len(best) // 2] / len(s)
    cut = float(np.quantile(s, level))
    slope = float(np.clip(logistic((s - cut)[:, None], y, 1e-4)[0], 0.05, 5))
    return {"mean": mean, "scale": scale, "w": w, "cut": cut, "slope": slope, "at": CUT}


def score(x: np.ndarray, model: dict) -> np.ndarray:
    z = np.clip((x - model["mean"]) / model["scale"], -8, 8) @ model["w"]
    return sigmoid(model["slope"] * (z - model["cut"]) + np.log(model["at"] / (1 - model["at"])))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict:
    """Fits on rows of the training folds; collects at most ``sample`` rows of features."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches):
            x = features(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(list(x), pa.list_(pa.float64()))], names=["doc_id", "label", "x"])

    chosen = labelled_sample(docs, labels, "quality", ~held_out(FOLDS, HELD_OUT), sample)
    found = sorted(chosen.select("doc_id", "text", "label").mapInArrow(rows, "doc_id long, label int, x array<double>").collect())
    return fit(np.array([r.x for r in found]).reshape(len(found), len(FEATURES)), np.array([r.label for r in found]))


def score_quality(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, held_out, score, predicted of each document."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches):
            s = score(features(batch.column(2).to_pylist()), model)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s), pa.array((s >= CUT).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    picked = docs.select(F.col("doc_id").cast("long"), held_out(FOLDS, HELD_OUT).alias("held_out"), "text")
    return picked.mapInArrow(rows, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: dict) -> DataFrame:
    """The documents at or above the cut, with the columns they had."""
    names = docs.columns

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches):
            good = score(features(batch.column(names.index("text")).to_pylist()), model) >= CUT
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(rows, docs.schema)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, train(docs, table(spark, sf_dir, "labels")))
