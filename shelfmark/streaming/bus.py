"""The event bus: typed events as a stream, a sink that takes each micro-batch once, and its subscribers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.sources.store import append_once, stream

#: The names of the events that the storefront knows.
TYPES = (
    "variant:selected", "variant:update", "cart:update", "cart:error", "media:started-playing", "quantity-selector:update", "megaMenu:hover", "zoom-media:selected",
    "discount:update", "filter:update",
)

#: detail is the event's payload as JSON; what it holds depends on the type.
EVENT = "event_id long, ts timestamp, type string, source_id string, detail string"


def published(spark: SparkSession, folder: str, delay: str, files: int = 1) -> DataFrame:
    """The bus's events as a stream, with a watermark; events of unknown types are left out."""
    return stream(spark, EVENT, folder, files).withWatermark("ts", delay).filter(F.col("type").isin(*TYPES))


def delivered(events: DataFrame, path: str, checkpoint: str) -> None:
    """Takes all that is there into the bus's table: a folder for each micro-batch and type, so that a batch that comes again
    replaces itself and a subscriber reads only its types. Goes on from the checkpoint."""
    events.writeStream.foreachBatch(append_once(path, ["type"])).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def subscribed(spark: SparkSession, path: str, types: Sequence[str], own: Column | None = None) -> DataFrame:
    """The delivered events of some types, without those that ``own`` says are the subscriber's."""
    rows = spark.read.schema(f"{EVENT}, batch int").parquet(path).drop("batch").filter(F.col("type").isin(*types))
    return rows if own is None else rows.filter(~F.coalesce(own, F.lit(False)))
