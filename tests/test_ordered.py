"""Ordered folds, the event bus and notices over several micro-batches, with restarts and repeated batches."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shelfmark.sources.store import append_once, drain, replay, settings, stream
from shelfmark.streaming import bus, ordered

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
CALLS = "key string, ts timestamp, n long, cancels boolean"
FAR = "2100-01-01"


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def append(spark, rows, schema, folder):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def throttle_by_definition(rows, wait):
    out, last = [], {}
    for key, ts, n, cancels in sorted(r for r in rows if r[0] is not None):
        if cancels:
            last[key] = ts
        elif key not in last or (ts - last[key]).total_seconds() >= wait:
            last[key] = ts
            out.append((key, n))
    return sorted(out)


def test_throttle_over_batches_and_a_restart(spark, tmp_path):
    rng = random.Random(1)
    rows = [(rng.choice("aab"), at(rng.randrange(600)), n, rng.random() < 0.2) for n in range(150)]
    late = sorted(rows, key=lambda r: r[1] + dt.timedelta(seconds=rng.randrange(30)))
    folder, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "checkpoint"))
    run = lambda: drain(ordered.throttled(stream(spark, CALLS, folder), ["key"], "ts", "40 seconds", 20_000, "n", "cancels"), out, checkpoint)
    append(spark, late[:60], CALLS, folder)
    append(spark, late[60:90], CALLS, folder)
    some = run().count()
    append(spark, late[90:], CALLS, folder)
    append(spark, [(None, at(10**8), None, None)], CALLS, folder)
    found = run()
    want = throttle_by_definition(rows, 20)
    assert 0 < some < len(want)
    assert sorted((r.key, r.value) for r in found.collect()) == want
    with settings(spark, spark__sql__streaming__stateStore__providerClass="org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"):
        left = spark.read.format("statestore").option("stateVarName", "state").load(checkpoint)
        assert left.count() == 0  # the wait of every key is over


def test_cancel_starts_the_wait_anew(spark, tmp_path):
    rows = [("a", at(0), 1, False), ("a", at(9), 2, True), ("a", at(11), 3, False), ("a", at(19), 4, False), ("b", at(0), 5, True), ("b", at(5), 6, False)]
    folder = replay(spark.createDataFrame(rows, CALLS), "ts", [F.col("n") < 3, F.col("n") >= 3], FAR)
    found = drain(ordered.throttled(stream(spark, CALLS, folder), ["key"], "ts", "1 minute", 10_000, "n", "cancels"), str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    assert sorted(r.value for r in found.collect()) == [1, 4]


def test_debounce_with_cancel_over_batches(spark, tmp_path):
    rng = random.Random(7)
    rows = [(rng.choice("aab"), at(s), n, rng.random() < 0.25) for n, s in enumerate(rng.sample(range(900), 120))]
    want, calls = [], {}
    by_key = {k: sorted((r[1], r[2], r[3]) for r in rows if r[0] == k) for k in "ab"}
    for key, own in by_key.items():
        for (ts, n, cancels), (after, *_) in zip(own, [*own[1:], (at(10**7),)], strict=True):
            calls[key] = 0 if cancels else calls.get(key, 0) + 1
            if not cancels and (after - ts).total_seconds() >= 10:
                want.append((key, n, calls.pop(key)))
    folder = replay(spark.createDataFrame(rows, CALLS), "ts", [F.col("ts") < at(300), (F.col("ts") >= at(300)) & (F.col("ts") < at(600)), F.col("ts") >= at(600)], FAR)
    found = drain(ordered.debounced(stream(spark, CALLS, folder), ["key"], "ts", "5 seconds", 10_000, "n", "cancels"), str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    assert sorted((r.key, r.value, r.calls) for r in found.collect()) == sorted(want) and len(want) > 20


def test_nothing_is_published_before_its_time(spark, tmp_path):
    schema = "drop string, ts timestamp, id long, due timestamp"
    folder, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "checkpoint"))
    run = lambda: sorted(r.id for r in drain(ordered.published_on_time(stream(spark, schema, folder), ["drop"], "ts", "0 seconds", "id", "due"), out, checkpoint).collect())
    append(spark, [("w1", at(0), 1, at(100)), ("w1", at(1), 2, at(300)), ("w2", at(2), 3, at(50))], schema, folder)
    assert run() == []
    append(spark, [("w9", at(120), 9, at(10**6))], schema, folder)
    assert run() == [1, 3]
    append(spark, [("w9", at(290), 8, at(20)), (None, at(400), None, None)], schema, folder)
    assert run() == [1, 2, 3, 8]
    append(spark, [(None, at(500), None, None)], schema, folder)
    assert run() == [1, 2, 3, 8]


def test_a_repeated_batch_of_the_bus_adds_nothing(spark, tmp_path):
    rows = [(i, at(i), t, f"user-{i % 3}", "{}") for i, t in enumerate(["cart:update", "variant:update", "unknown", "cart:update", "cart:error"])]
    path, checkpoint = str(tmp_path / "bus"), str(tmp_path / "checkpoint")
    folder = replay(spark.createDataFrame(rows, bus.EVENT), "ts", [F.col("event_id") < 2, F.col("event_id") >= 2])
    bus.delivered(bus.published(spark, folder, "1 hour"), path, checkpoint)
    first = sorted(map(tuple, bus.subscribed(spark, path, bus.TYPES).collect()))
    assert [r[0] for r in first] == [0, 1, 3, 4]
    again = spark.createDataFrame(rows[2:], bus.EVENT).filter(F.col("type").isin(*bus.TYPES))
    append_once(path, ["type"])(again, 1)
    bus.delivered(bus.published(spark, folder, "1 hour"), path, checkpoint)
    assert sorted(map(tuple, bus.subscribed(spark, path, bus.TYPES).collect())) == first
    carts = bus.subscribed(spark, path, ["cart:update"], F.col("source_id") == "user-0")
    assert carts.count() == 0 and bus.subscribed(spark, path, ["cart:update"]).count() == 2
    plan = bus.subscribed(spark, path, ["cart:update"])._jdf.queryExecution().executedPlan().toString()
    assert "cart:update" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0]


def test_one_notice_for_each_return_and_customer(spark, tmp_path):
    schema = "film long, ts timestamp, event string"
    folder, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "checkpoint"))
    waiting = spark.createDataFrame([(1, "x"), (1, "x"), (1, "y"), (2, "z")], "film long, customer string")
    run = lambda: sorted((r.event, r.customer) for r in drain(ordered.notices_once(stream(spark, schema, folder), "ts", "1 hour", "event", waiting, "film", "customer"), out, checkpoint).collect())
    append(spark, [(1, at(0), "e1"), (1, at(1), "e1"), (3, at(2), "e2")], schema, folder)
    append(spark, [(1, at(3), "e1"), (2, at(4), "e3")], schema, folder)
    assert run() == [("e1", "x"), ("e1", "y"), ("e3", "z")]
    append(spark, [(2, at(5), "e3"), (1, at(6), "e4")], schema, folder)
    assert run() == [("e1", "x"), ("e1", "y"), ("e3", "z"), ("e4", "x"), ("e4", "y")]


def test_counts_over_batches(spark, tmp_path):
    schema = "key string, ts timestamp, id long, form boolean, n long"
    rows = [("a", at(0), 1, True, 2), ("a", at(5), 2, True, 3), ("a", at(3), 3, False, 9), ("b", at(1), 4, True, 1)]
    folder = replay(spark.createDataFrame(rows, schema), "ts", [F.col("id") < 3, F.col("id") >= 3], FAR)
    found = drain(ordered.optimistic_counts(stream(spark, schema, folder), ["key"], "ts", "1 hour", "id", "form", "n"), str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    assert sorted((r.id, r["count"]) for r in found.collect()) == [(1, 2), (2, 12), (3, 9), (4, 1)]


def test_settings_are_put_back(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with pytest.raises(ValueError), settings(spark, spark__sql__shuffle__partitions="3"):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
        raise ValueError
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_keys_share_the_state_of_a_bucket(spark, tmp_path):
    """What the state store holds, and is asked for, is bounded by the buckets, not by the keys."""
    schema = "key long, ts timestamp, id long, form boolean, n long"
    rows = [(key, at(i), 1000 * i + key, True, i) for key in range(900) for i in (1, 2)]
    folder, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "checkpoint"))
    append(spark, rows, schema, folder)
    append(spark, [(None, at(10**6), None, None, None)], schema, folder)
    found = drain(ordered.optimistic_counts(stream(spark, schema, folder), ["key"], "ts", "1 hour", "id", "form", "n"), out, checkpoint)
    assert sorted((r.key, r.id, r["count"]) for r in found.collect()) == sorted((k, 1000 * i + k, [0, 1, 3][i]) for k in range(900) for i in (1, 2))
    with settings(spark, spark__sql__streaming__stateStore__providerClass="org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"):
        assert 0 < spark.read.format("statestore").option("stateVarName", "state").load(checkpoint).count() <= 512


def test_large_ids_beside_nulls_stay_exact(spark, tmp_path):
    big = 2**60 + 1
    rows = [("a", at(0), big, False), ("a", at(100), None, False), ("a", at(200), big + 2, None), ("b", at(0), None, True), (None, at(300), 5, False)]
    folder = replay(spark.createDataFrame(rows, CALLS), "ts", [F.lit(True)], FAR)
    found = drain(ordered.throttled(stream(spark, CALLS, folder), ["key"], "ts", "1 minute", 10_000, "n", "cancels"), str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    assert sorted((r.key, -1 if r.value is None else r.value) for r in found.collect()) == [("a", -1), ("a", big), ("a", big + 2)]


def test_a_slice_of_several_files_is_one_micro_batch(spark, tmp_path):
    rows = spark.createDataFrame([("a", at(n), n, False) for n in range(40)], CALLS)
    folder = replay(rows, "ts", [F.col("n") < 2, F.col("n") < 0, F.col("n") >= 2], FAR, files=4)
    assert len(spark.read.schema(CALLS).parquet(folder).inputFiles()) == 13
    sizes = []
    stream(spark, CALLS, folder, 4).writeStream.foreachBatch(lambda batch, _: sizes.append(batch.count())).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert sizes == [2, 0, 38, 1]
