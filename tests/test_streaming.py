"""The folds over real streams."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from shelfmark.operators import curation
from shelfmark.sources.store import drain
from shelfmark.streaming import folds, ordered

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def stream_of(spark, rows, schema, tmp_path):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "in"))
    return spark.readStream.schema(schema).parquet(str(tmp_path / "in"))


def drained(stream, name, mode):
    query = stream.writeStream.format("memory").queryName(name).outputMode(mode).start()
    try:
        query.processAllAvailable()
        return stream.sparkSession.sql(f"SELECT * FROM {name}").collect()
    finally:
        query.stop()


def test_throttle_lets_the_leading_event_through(spark, tmp_path):
    at = lambda ms: T0 + dt.timedelta(milliseconds=ms)
    rows = [("a", at(0), 1, False), ("a", at(50), 2, False), ("a", at(120), 3, False), ("b", at(10), 4, False), (None, at(10**6), None, None)]
    stream = stream_of(spark, rows, "key string, ts timestamp, value int, cancels boolean", tmp_path)
    throttled = ordered.throttled(stream, ["key"], "ts", "1 second", 100, "value", "cancels")
    found = drain(throttled, str(tmp_path / "out"), str(tmp_path / "checkpoint")).collect()
    assert sorted((r.key, r.value) for r in found) == [("a", 1), ("a", 3), ("b", 4)]


def test_debounce_on_a_stream(spark, tmp_path):
    at = lambda s: T0 + dt.timedelta(seconds=s)
    rows = [("a", at(0), 1), ("a", at(1), 2), ("a", at(10), 3), ("a", at(100), 4)]
    stream = stream_of(spark, rows, "key string, ts timestamp, value int", tmp_path)
    found = drained(folds.debounced(stream, "ts", ["key"], "5 seconds", F.col("value"), watermark="1 second"), "debounced", "append")
    assert sorted((r.payload, r.calls) for r in found) == [(2, 2), (3, 1)]  # the last burst is still open


def test_waitlist_joins_a_stream_with_a_table(spark, tmp_path):
    stream = stream_of(spark, [(1,), (3,)], "film long", tmp_path)
    waiting = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z")], "film long, customer string")
    found = drained(curation.waitlist_matches(stream, waiting, "film"), "waitlist", "append")
    assert sorted(r.customer for r in found) == ["x", "y"]


def test_optimistic_count_without_a_set_value(spark):
    rows = spark.createDataFrame([("a", 1, True, 2), ("a", 2, True, 3), ("b", 1, False, 9), ("b", 2, True, 1), ("b", 3, False, 4)], "k string, i int, form boolean, n long")
    found = folds.optimistic_counts(rows, ["k"], ["i"], "form", "n").collect()
    assert sorted((r.k, r["count"]) for r in found) == [("a", 5), ("b", 4)]
