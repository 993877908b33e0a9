"""Sums of arrays over tasks, whatever they are cut into."""

from __future__ import annotations

import numpy as np
import pytest

from shelfmark.llm import _sums


@pytest.mark.parametrize(("size", "block_bytes"), [(5, 1 << 22), (1000, 80), (100_003, 4096)])
def test_sums_of_arrays(spark, monkeypatch, size, block_bytes):
    monkeypatch.setattr(_sums, "BLOCK_BYTES", block_bytes)
    cut = max(_sums.BLOCKS, -(-8 * size // block_bytes))

    def make(batches):
        _sums.BLOCK_BYTES = block_bytes  # in the worker
        for batch in batches:
            for i in batch.column(0).to_pylist():
                yield _sums.batch(np.arange(size) * float(i))

    rows = spark.range(1, 12, 1, 5).mapInArrow(make, _sums.SCHEMA)
    assert rows.select("block").distinct().count() == cut
    assert (_sums.added(rows, size) == np.arange(size) * 66.0).all()
    assert (_sums.added(rows.limit(0), size) == 0).all()
