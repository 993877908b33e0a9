"""Tables in the folder that driver and executors share, streams of them, and sinks that repeat safely."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: State for timers and lists needs this provider.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir; one of our own only where none is set and all runs on one machine."""
    found = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = f"file://{tempfile.mkdtemp(prefix='shelfmark-')}"
        spark.sparkContext.setCheckpointDir(found)
    return f"{found.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(rows: DataFrame, name: str) -> DataFrame:
    """rows as a table in the shared folder: computed once, and safe when executors are lost."""
    path = shared_folder(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings (dots written as two underscores) for as long as the block runs."""
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stored_in(rows: DataFrame, name: str, tasks: int) -> DataFrame:
    """rows as a table in the shared folder, with so many tasks in each of its shuffles; with tasks in proportion to the input, what one
    holds in memory doesn't grow with it. Adaptive execution would join them again until there are as few as cores."""
    with settings(rows.sparkSession, spark__sql__shuffle__partitions=str(tasks), spark__sql__adaptive__coalescePartitions__enabled="false"):
        return stored(rows, name)


def file_count(rows: DataFrame) -> int:
    """How many files a slice of rows is written as: as many as the tasks that read them, so it grows with the input."""
    return max(1, rows.rdd.getNumPartitions())


def replay(rows: DataFrame, by: str, slices: Sequence[Column], until: str | None = None, files: int = 1) -> str:
    """Writes rows as the files of a stream, a slice after the other, and returns their folder.

    Each slice is a condition; slices are written in turn, so the files' times are in that order. Each is exactly ``files`` files,
    some of them empty where it has few rows, so a stream that takes as many at once takes a slice whole. until: the event time of
    a last row, all of whose other columns are null; it lets everything before it be settled.
    """
    spark, path = rows.sparkSession, shared_folder(rows.sparkSession, "replay")
    for number, condition in enumerate(slices, 1):
        own = rows.filter(condition)
        dealt = own.repartition(files) if files > 1 else own.coalesce(1)
        dealt.sortWithinPartitions(by).write.mode("append").parquet(path)
        for _ in range(files * number - len(spark.read.schema(rows.schema).parquet(path).inputFiles()) if files > 1 else 0):
            spark.createDataFrame([], rows.schema).coalesce(1).write.mode("append").parquet(path)
    if until:
        last = spark.range(1).select(*(F.lit(until if f.name == by else None).cast(f.dataType).alias(f.name) for f in rows.schema))
        last.coalesce(1).write.mode("append").parquet(path)
    return path


def stream(spark: SparkSession, schema, path: str, files: int = 1) -> DataFrame:
    """The files of a folder as a stream, so many in each micro-batch; the schema is stated, nothing is inferred."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def drain(out: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Runs a stream over all that is there into a table that takes every micro-batch once, and reads the table.

    With the same checkpoint a later call goes on where this one ended.
    """
    spark = out.sparkSession
    states = str(spark.sparkContext.defaultParallelism)  # every state partition is a task of every micro-batch
    with settings(spark, spark__sql__streaming__stateStore__providerClass=ROCKSDB, spark__sql__shuffle__partitions=states):
        query = out.writeStream.format("parquet").outputMode(mode).option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(out.schema).parquet(path)


def append_once(path: str, partitions: Sequence[str] = ()):
    """For foreachBatch: each micro-batch has a folder of its own by its number, so a batch that is repeated replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").partitionBy(*partitions).parquet(f"{path}/batch={number}")

    return write
