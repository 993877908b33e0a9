"""Small convex fits on bounded samples, and the samples themselves."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(modulus: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo; a null id has none."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus


def held_out(modulus: int, remainder: int) -> Column:
    """Rows without an id are not held out (they have no label either)."""
    return F.coalesce(fold(modulus) == remainder, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, train: Column, most: int) -> DataFrame:
    """(doc_id, text, label) of at most ``most`` training rows, those with the smallest hashes of their ids.

    The sampled ids are bounded by ``most`` and hence broadcast. An id with more than one label gets the smallest;
    of documents that repeat an id the text with the smallest hash is taken.
    """
    rows = labels.select(F.col("doc_id").cast("long"), F.col(label).cast("int").alias("label")).filter("doc_id is not null and label is not null")
    rows = rows.filter(train).groupBy("doc_id").agg(F.min("label").alias("label"))
    chosen = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    joined = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(chosen), "doc_id")
    return joined.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.first("label").alias("label"))


def logistic(x: np.ndarray, y: np.ndarray, l2: float, steps: int = 30, prior: np.ndarray | None = None) -> np.ndarray:
    """Weights that minimise the mean logistic loss plus l2/2 |w - prior|^2, by damped Newton steps; without a prior it is zero."""
    w0, n = np.zeros(x.shape[1]) if prior is None else prior, max(1, len(x))
    w = w0.copy()
    loss = lambda w: np.logaddexp(0, np.where(y > 0, -1.0, 1.0) * (x @ w)).sum() / n + l2 / 2 * (w - w0) @ (w - w0)
    for _ in range(steps):
        p = sigmoid(x @ w)
        grad = x.T @ (p - y) / n + l2 * (w - w0)
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x / n + l2 * np.eye(len(w)), grad)
        size, now = 1.0, loss(w)
        while size > 1e-4 and loss(w - size * step) > now:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))
