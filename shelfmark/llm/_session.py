"""The folder that driver and executors share, and tables written there to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, as Spark qualified it (a path without a scheme is the default file system's); one of our own only where none is set and driver and executors are one machine, as in tests."""
    found = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = f"file://{tempfile.mkdtemp(prefix='shelfmark-')}"
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: computed once, and safe when executors are lost."""
    return written_at(df, name)[0]


def written_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The same, and the folder, to be deleted when nothing reads it any more."""
    spark, path = df.sparkSession, new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def deleted(path: str) -> None:
    store, root = fs.FileSystem.from_uri(path)
    store.delete_dir(root)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
