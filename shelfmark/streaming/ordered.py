"""Folds of event streams in the order of event time, with keyed state and timers.

Events of a key wait until the watermark has passed them, so that whatever the micro-batches, each is met once and in order; a
timer calls for the first that waits. The state of a key is dropped when its time is over. What waits is bounded by the
watermark's delay, for each key. Keys are dealt into buckets, which wait, are read and are written together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import ArrayType, IntegralType, StructField, StructType

State = tuple | None
NULLS = "nulls"
#: (state, time in microseconds, the event's other values) -> state, rows to emit without their key.
Step = Callable[[State, int, tuple], tuple[State, list[tuple]]]
#: What a state says when its time is over.
Close = Callable[[tuple], list[tuple]]


class OrderedFold(StatefulProcessor):
    """Keys share a bucket, whose waiting events and whose states are one value each, columns as arrays: what a micro-batch asks of the
    state store depends on the buckets, not on the keys."""

    def __init__(self, held: StructType, state: StructType, keys: Sequence[str], columns: Sequence[str], out: Sequence[str], step: Step, ends: Callable[[tuple], int | None], close: Close):
        self.held_schema, self.state_schema = _arrays(held), _arrays(state)
        self.keys, self.columns, self.out, self.step, self.ends, self.close_state = len(keys), list(columns), list(out), step, ends, close

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getValueState("waiting", self.held_schema)
        self.state = handle.getValueState("state", self.state_schema)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        new: list[tuple] = []
        for batch in rows:
            each = zip(*(batch[c].tolist() for c in self.columns), strict=True)
            new += [row if not nulls else tuple(None if nulls >> i & 1 else x for i, x in enumerate(row)) for row, nulls in zip(each, batch[NULLS].tolist(), strict=True)]
        yield self.settled(new, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        yield self.settled([], timerValues.getCurrentWatermarkInMs())

    def settled(self, new: list[tuple], watermark: int) -> pd.DataFrame:
        now, width = watermark * 1000, len(self.columns) - self.keys
        waiting = [*(zip(*self.waiting.get(), strict=True) if self.waiting.exists() else ()), *new]
        try:
            waiting.sort()
        except TypeError:  # nulls come last
            waiting.sort(key=lambda r: [(x is None, x) for x in r])
        states: dict[tuple, tuple] = {r[: self.keys]: r[self.keys :] for r in zip(*self.state.get(), strict=True)} if self.state.exists() else {}
        out: list[tuple] = []

        def closed(key: tuple, now: int) -> State:
            state = states.get(key)
            ends = self.ends(state) if state is not None else None
            if ends is None or ends > now:
                return state
            out.extend((*key, *row) for row in self.close_state(state))
            del states[key]
            return None

        done = 0
        for row in waiting:
            if row[0] > now:
                break
            key = row[width:]
            state, rows = self.step(closed(key, row[0]), row[0], row[1:width])
            if state is not None:
                states[key] = state
            else:
                states.pop(key, None)
            out += [(*key, *r) for r in rows]
            done += 1
        for key in list(states):
            closed(key, now)
        rest = waiting[done:]
        self.waiting.update(tuple(map(list, zip(*rest, strict=True)))) if rest else self.waiting.clear()
        self.state.update(tuple(map(list, zip(*((*k, *v) for k, v in states.items()), strict=True)))) if states else self.state.clear()
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        wake = [at for at in (rest[0][0] if rest else None, *map(self.ends, states.values())) if at is not None]
        if wake:
            self.handle.registerTimer(max(-(-min(wake) // 1000), watermark + 1))
        columns = zip(*out, strict=True) if out else [()] * len(self.out)
        return pd.DataFrame({c: pd.Series(x, dtype=object) for c, x in zip(self.out, columns, strict=True)})

    def close(self) -> None:
        pass


def ordered_fold(
    events: DataFrame,
    keys: Sequence[str],
    ts: str,
    delay: str,
    values: Sequence[str],
    state: str,
    step: Step,
    out: str,
    ends: Callable[[tuple], int | None] = lambda state: None,
    at: Column | None = None,
    close: Close = lambda state: [],
    buckets: int = 512,
) -> DataFrame:
    """A stream folded for each key in the order of ts (or of ``at``, in microseconds, not before ts) and then of the values.

    state, out: schemas of the state and of the emitted columns (the keys come first). ends: when, in microseconds, a state is
    over and forgotten, null for never; close: what it gives then. Events that are later than the delay behind the newest are left out, as watermarks do; rows
    without any key only carry time. buckets: into how many groups the keys are dealt by a hash; the same for each run of a stream.
    """
    marked = events.withWatermark(ts, delay).withColumn("at_us", F.unix_micros(ts) if at is None else F.greatest(F.unix_micros(ts), at))
    kinds = {f.name: f.dataType.simpleString() for f in marked.schema}
    columns = ["at_us", *values, *keys]
    ddl = lambda names: ", ".join(f"{c} {kinds[c]}" for c in names)
    schema, held = StructType.fromDDL(f"{ddl(keys)}, {out}"), StructType.fromDDL(ddl(columns))
    held = StructType([StructField(f"held{i}", f.dataType) for i, f in enumerate(held)])  # a value can be a key too
    states = StructType([*(StructField(f"key{i}", marked.schema[k].dataType) for i, k in enumerate(keys)), *StructType.fromDDL(state)])
    fold = OrderedFold(held, states, keys, held.names, schema.names, step, ends, close)
    # Names don't begin with an underscore, which PySpark would replace. A condition without ts would be moved before the watermark, which then didn't see the rows that only carry time.
    keyed = marked.filter(F.when(F.col(ts).isNotNull(), _any_key(keys)))
    # Whole numbers would come as doubles where some are null: nulls are bits of a number, and what stands in their place is not read.
    nulls = sum((F.when(F.col(c).isNull(), 1 << i).otherwise(0).cast("long") for i, c in enumerate(columns)), F.lit(0).cast("long"))
    filled = [(F.coalesce(c, F.lit(0).cast(kinds[c])) if isinstance(marked.schema[c].dataType, IntegralType) else F.col(c)).alias(n) for c, n in zip(columns, held.names, strict=True)]
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("bucket")
    return keyed.select(bucket, F.col(ts).alias("held_ts"), nulls.alias(NULLS), *filled).groupBy("bucket").transformWithStateInPandas(fold, schema, "append", "eventTime")


def _arrays(schema: StructType) -> StructType:
    return StructType([StructField(f.name, ArrayType(f.dataType)) for f in schema])


def _any_key(keys: Sequence[str]) -> Column:
    """Rows without any key only carry time."""
    return ~F.forall(F.array(*(F.col(k).cast("string") for k in keys)), lambda x: x.isNull())


def throttled(events: DataFrame, keys: Sequence[str], ts: str, delay: str, wait_ms: int, value: str, cancel: str) -> DataFrame:
    """keys, at, value: the first call of each key, then one as soon as the wait since the last one let through is over.

    Where the boolean column cancel is true the event is no call: it starts the wait anew. State is gone when the wait is over.
    """
    wait = wait_ms * 1000

    def step(state: State, at: int, event: tuple) -> tuple[State, list[tuple]]:
        own, cancels = event
        if cancels:
            return (at,), []
        if state is None or at - state[0] >= wait:
            return (at,), [(pd.Timestamp(at, unit="us", tz="UTC"), own)]
        return state, []

    kind = {f.name: f.dataType.simpleString() for f in events.schema}[value]
    return ordered_fold(events, keys, ts, delay, [value, cancel], "at long", step, f"at timestamp, value {kind}", lambda state: state[0] + wait)


def debounced(events: DataFrame, keys: Sequence[str], ts: str, delay: str, wait_ms: int, value: str, cancel: str) -> DataFrame:
    """keys, at, value, calls: the last call of each burst, when nothing has come for the wait; each call begins the wait anew.

    Where the boolean column cancel is true the event is no call: what is pending is dropped.
    """
    wait = wait_ms * 1000

    def step(state: State, at: int, event: tuple) -> tuple[State, list[tuple]]:
        own, cancels = event
        return (None if cancels else (at, own, (state[2] if state else 0) + 1)), []

    kind = {f.name: f.dataType.simpleString() for f in events.schema}[value]
    close: Close = lambda state: [(pd.Timestamp(state[0], unit="us", tz="UTC"), state[1], state[2])]
    return ordered_fold(events, keys, ts, delay, [value, cancel], f"at long, value {kind}, calls long", step, f"at timestamp, value {kind}, calls long", lambda state: state[0] + wait, close=close)


def published_on_time(rows: DataFrame, keys: Sequence[str], ts: str, delay: str, row_id: str, due: str) -> DataFrame:
    """keys, row_id, published: each row once, when event time has reached its time to be published.

    ts is when a row became known; one that was known too late is published as soon as it is. Rows wait in the state of their
    key (a weekly drop, a shop, a user), one timer for the next of them.
    """
    kind = {f.name: f.dataType.simpleString() for f in rows.schema}[row_id]
    step: Step = lambda state, at, event: (None, [(event[0], pd.Timestamp(at, unit="us", tz="UTC"))])
    return ordered_fold(rows, keys, ts, delay, [row_id], "unused boolean", step, f"{row_id} {kind}, published timestamp", at=F.unix_micros(due))


def queued_while_busy(events: DataFrame, keys: Sequence[str], ts: str, delay: str, tie: str, kind: str, start: str, end: str, item: str, quantity: str) -> DataFrame:
    """keys, released, item, quantity: what was added while a change was pending, in one batch when it ends.

    The stream's form of the batch fold of the same name: the queue is in the key's state, released by the end event.
    """

    def step(state: State, at: int, event: tuple) -> tuple[State, list[tuple]]:
        own, what, which, count = event
        queue = dict(zip(*state, strict=True)) if state else {}
        if what == end:
            return None, [(own, i, n) for i, n in queue.items()]
        if state is None and what != start:
            return None, []
        if what != start:
            queue[which] = queue.get(which, 0) + count
        return (list(queue), list(queue.values())), []

    kinds = {f.name: f.dataType.simpleString() for f in events.schema}
    state = f"items array<{kinds[item]}>, counts array<long>"
    return ordered_fold(events, keys, ts, delay, [tie, kind, item, quantity], state, step, f"released {kinds[tie]}, item {kinds[item]}, quantity long")


def optimistic_counts(events: DataFrame, keys: Sequence[str], ts: str, delay: str, tie: str, from_form: str, change: str) -> DataFrame:
    """keys, at, tie, count: the count after each event in order: a product form adds, anything else sets it."""

    def step(state: State, at: int, event: tuple) -> tuple[State, list[tuple]]:
        own, adds, n = event
        count = (state[0] if state and adds else 0) + n
        return (count,), [(pd.Timestamp(at, unit="us", tz="UTC"), own, count)]

    kind = {f.name: f.dataType.simpleString() for f in events.schema}[tie]
    return ordered_fold(events, keys, ts, delay, [tie, from_form, change], "count long", step, f"at timestamp, {tie} {kind}, count long")


def notices_once(returned: DataFrame, ts: str, delay: str, event: str, waiting: DataFrame, item: str, customer: str) -> DataFrame:
    """Who waits for what has come back, one notice for each return and customer.

    Return events that come again within the delay, in the same micro-batch or a later one, are dropped before the join; the table
    of who waits is static. Rows of the table that repeat a customer for an item are one.
    """
    once = returned.withWatermark(ts, delay).dropDuplicatesWithinWatermark([event])
    return once.join(waiting.select(item, customer).distinct(), item)
