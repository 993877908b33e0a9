"""Folds over event streams; every function takes a batch or a streaming DataFrame alike unless it says otherwise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def from_others(events: DataFrame, source_id: str, own: str) -> DataFrame:
    """Without the events that we sent ourselves."""
    return events.filter(~F.col(source_id).eqNullSafe(F.lit(own)))


def debounced(events: DataFrame, ts: str, keys: list[str], gap: str, payload: Column, watermark: str | None = None, tie: str | None = None) -> DataFrame:
    """The last payload of each burst; a burst ends after a quiet gap (event time stands for the clock). Of events at one
    time the one with the largest tie, or else the largest payload, is the last."""
    source = events.withWatermark(ts, watermark) if watermark else events
    grouped = source.groupBy(F.session_window(ts, gap), *keys)
    last = grouped.agg(F.max_by(payload, F.struct(F.col(ts), F.col(tie) if tie else payload)).alias("payload"), F.count("*").alias("calls"))
    return last.select(*keys, F.col("session_window.start").alias("burst_start"), F.col("session_window.end").alias("burst_end"), "payload", "calls")


def latest(events: DataFrame, keys: list[str], ts: str, tie: str, payload: list[str]) -> DataFrame:
    """Of each key the last event's payload: a later request supersedes all before it."""
    return events.groupBy(*keys).agg(F.max(F.struct(ts, tie, *payload)).alias("_x")).select(*keys, *(f"_x.{c}" for c in payload))


def queued_while_busy(events: DataFrame, keys: list[str], order: list[str], kind: str, start: str, end: str, item: str, quantity: str) -> DataFrame:
    """keys, released (the place of the change that ended), item, quantity: what was added while a change was pending, in one
    batch when it ends; adds of one item are summed (batch only). Adds while nothing is pending aren't queued."""
    by = Window.partitionBy(*keys).orderBy(*order)
    marker = F.when(F.col(kind).isin(start, end), F.col(kind))
    ends = F.when(F.col(kind) == end, F.struct(*order))
    seen = events.withColumn("_state", F.last(marker, ignorenulls=True).over(by)).withColumn("_end", F.first(ends, ignorenulls=True).over(by.rowsBetween(1, Window.unboundedFollowing)))
    queued = seen.filter((F.col("_state") == start) & ~F.col(kind).isin(start, end) & F.col("_end").isNotNull())
    return queued.groupBy(*keys, F.col("_end")[order[-1]].alias("released"), item).agg(F.sum(quantity).alias("quantity"))


def optimistic_counts(events: DataFrame, keys: list[str], order: list[str], from_form: str, change: str) -> DataFrame:
    """The count after all events in order: a product form adds, anything else sets it.

    That is the last value set plus what was added since, two aggregates without an ordered fold (batch only).
    """
    at = F.struct(*order)
    set_last = events.filter(~F.col(from_form)).groupBy(*keys).agg(F.max(F.struct(at.alias("at"), F.col(change).alias("v"))).alias("_set"))
    joined = events.join(set_last, keys, "left")
    added = F.when(F.col(from_form) & F.coalesce(at > F.col("_set.at"), F.lit(True)), F.col(change)).otherwise(0)
    return joined.groupBy(*keys).agg((F.coalesce(F.max("_set.v"), F.lit(0)) + F.sum(added)).alias("count"))
