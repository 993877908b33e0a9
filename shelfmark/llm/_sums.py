"""Sums of equally long arrays that many tasks have: added up block by block, in levels of partial groups."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: An array is cut into BLOCKS blocks at least, of BLOCK_BYTES at most; a group adds up at most FAN tasks' blocks (so it holds FAN *
#: BLOCK_BYTES, far below the 2 GB that a column of bytes can have), for up to FAN**LEVELS tasks.
BLOCKS, BLOCK_BYTES, FAN, LEVELS = 16, 1 << 22, 64, 3
SCHEMA = "block int, grp int, part binary"


def blocks(total: np.ndarray) -> tuple[list[int], list[int], list[bytes]]:
    """Columns of SCHEMA for the array of the task that calls."""
    n = max(BLOCKS, -(-8 * total.size // BLOCK_BYTES))
    parts = [x.astype(np.float64).tobytes() for x in np.array_split(total.ravel(), n)]
    return list(range(n)), [TaskContext.get().partitionId()] * n, parts


def batch(total: np.ndarray) -> pa.RecordBatch:
    at, groups, parts = blocks(total)
    return pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(groups, pa.int32()), pa.array(parts, pa.binary())], names=["block", "grp", "part"])


def added(sums: DataFrame, size: int) -> np.ndarray:
    """The sum, on the driver; zeros without rows."""

    def add(held: pa.Table) -> pa.Table:
        whole = np.zeros(len(held["part"][0].as_py()) // 8)
        for x in held["part"]:
            whole += np.frombuffer(x.as_buffer(), np.float64)
        return pa.table({"block": held["block"][:1], "grp": held["grp"][:1], "part": pa.array([whole.tobytes()], pa.binary())})

    for _ in range(LEVELS):
        sums = sums.withColumn("grp", F.expr(f"grp div {FAN}").cast("int")).groupBy("block", "grp").applyInArrow(add, SCHEMA)
    rows = sums.groupBy("block").applyInArrow(add, SCHEMA).collect()
    return np.concatenate([np.frombuffer(r.part, np.float64) for r in sorted(rows, key=lambda r: r.block)]) if rows else np.zeros(size)
