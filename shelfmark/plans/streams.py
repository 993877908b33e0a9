"""Registered queries that run as streams: the given tables are replayed in slices of time, a micro-batch each, and events reach a
slice up to two days late. What they return is what the batch query or its SQL gives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.plans.queries import read
from shelfmark.plans.registry import ORACLES, query
from shelfmark.sources.store import drain, file_count, replay, shared_folder, stream
from shelfmark.streaming import bus, ordered

#: Later than what arrives late; a last row far beyond the others lets all of them be settled.
DELAY, FAR = "3 days", "2100-01-01 00:00:00"


def instant(ts: str) -> Column:
    """A time without a zone as an instant in UTC, whatever the session's zone."""
    return F.timestamp_micros(F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', {ts})"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").withColumn("ts", instant("ts"))


def slices(row_id: str, days: int = 12, count: int = 3) -> list[Column]:
    """Slices of days, each row up to two days late by its id; the first and last take what lies outside."""
    day = F.expr(f"(datediff(cast(ts as date), DATE '2024-01-01') + {row_id} % 3) div {days}")
    return [day <= 0, *(day == i for i in range(1, count - 1)), day >= count - 1]


def replayed(rows: DataFrame, row_id: str) -> DataFrame:
    """rows as a stream in several micro-batches, and a last row that only carries time."""
    files = file_count(rows)
    folder = replay(rows, "ts", slices(row_id), until=FAR, files=files)
    return stream(rows.sparkSession, rows.schema, folder, files)


def drained(out: DataFrame, name: str) -> DataFrame:
    return drain(out, shared_folder(out.sparkSession, name), shared_folder(out.sparkSession, f"{name}-checkpoint"))


@query("""WITH RECURSIVE e AS (SELECT user_id, ts, event_id, event_type = 'error' AS cancels, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
f AS (SELECT user_id, i, ts AS last, event_id, NOT cancels AS called FROM e WHERE i = 1
  UNION ALL SELECT e.user_id, e.i, CASE WHEN cancels OR e.ts - last >= INTERVAL 6 HOUR THEN e.ts ELSE last END, e.event_id, NOT cancels AND e.ts - last >= INTERVAL 6 HOUR
  FROM f JOIN e ON e.user_id = f.user_id AND e.i = f.i + 1)
SELECT user_id, event_id FROM f WHERE called""")
def throttle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's events at most once in six hours; an error cancels, which starts the six hours anew."""
    rows = events(spark, sf_dir).select("ts", "user_id", "event_id", (F.col("event_type") == "error").alias("cancels"))
    out = ordered.throttled(replayed(rows, "event_id"), ["user_id"], "ts", DELAY, 6 * 3_600_000, "event_id", "cancels")
    return drained(out, "throttle").select("user_id", F.col("value").alias("event_id"))


@query("""WITH e AS (SELECT user_id, event_id, ts, event_type = 'error' AS cancels, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next FROM events)
SELECT user_id, event_id FROM e WHERE NOT cancels AND (next IS NULL OR next >= ts + INTERVAL 5 HOUR)""")
def debounce_cancel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last event of each burst of a user's; an error cancels what is pending."""
    rows = events(spark, sf_dir).select("ts", "user_id", "event_id", (F.col("event_type") == "error").alias("cancels"))
    out = ordered.debounced(replayed(rows, "event_id"), ["user_id"], "ts", DELAY, 5 * 3_600_000, "event_id", "cancels")
    return drained(out, "debounce").select("user_id", F.col("value").alias("event_id"))


_BUS = {"view": "variant:selected", "click": "variant:update", "purchase": "cart:update", "error": "cart:error", "signup": "discount:update"}


@query("""SELECT event_id, epoch_us(ts) AS at_us, CASE event_type WHEN 'click' THEN 'variant:update' WHEN 'purchase' THEN 'cart:update' END AS type, 'user-' || user_id AS source_id, props AS detail
FROM events WHERE event_type IN ('click', 'purchase') AND user_id % 10 <> 7""")
def event_bus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events go over the bus; a subscriber takes two types, without what some users sent."""
    kind = F.create_map(*(F.lit(x) for pair in _BUS.items() for x in pair))[F.col("event_type")]
    rows = events(spark, sf_dir).select("event_id", "ts", kind.alias("type"), F.concat(F.lit("user-"), F.col("user_id")).alias("source_id"), F.col("props").alias("detail"))
    path = shared_folder(spark, "bus")
    files = file_count(rows)
    sent = bus.published(spark, replay(rows, "ts", slices("event_id"), files=files), DELAY, files)
    bus.delivered(sent, path, shared_folder(spark, "bus-checkpoint"))
    found = bus.subscribed(spark, path, ["variant:update", "cart:update"], F.col("source_id").endswith("7"))
    return found.select("event_id", F.unix_micros("ts").alias("at_us"), "type", "source_id", "detail")


@query("SELECT user_id, event_id, epoch_us(ts + event_id % 5 * INTERVAL 7 HOUR) AS at_us FROM events")
def weekly_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event becomes known at its time and is published some hours later."""
    rows = events(spark, sf_dir).select("ts", "user_id", "event_id", F.timestamp_micros(F.expr("unix_micros(ts) + event_id % 5 * 25200000000")).alias("due"))
    out = ordered.published_on_time(replayed(rows, "event_id"), ["user_id"], "ts", DELAY, "event_id", "due")
    return drained(out, "weekly-drop").select("user_id", "event_id", F.unix_micros("published").alias("at_us"))


@query("""SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, w.o_custkey FROM lineitem JOIN (SELECT o_orderkey % 200 + 1 AS part, o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') w ON w.part = l_partkey
WHERE l_returnflag = 'R'""")
def return_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returned lines, a third of them sent twice, meet those who wait for a part."""
    lines = read(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select("l_orderkey", "l_linenumber", "l_partkey", instant("l_shipdate").alias("ts"))
    rows = lines.withColumn("line", F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey"))
    early = F.year("ts") < 1995
    files = file_count(rows)
    folder = replay(rows, "ts", [early, early & (F.col("l_orderkey") % 3 == 0), ~early, ~early & (F.col("l_orderkey") % 3 == 0)], files=files)
    waiting = read(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'").select((F.col("o_orderkey") % 200 + 1).alias("l_partkey"), "o_custkey")
    out = ordered.notices_once(stream(spark, rows.schema, folder, files), "ts", "5000 days", "line", waiting, "l_partkey", "o_custkey")
    return drained(out.select("l_orderkey", "l_linenumber", "l_partkey", "o_custkey"), "return-notices")


@query(ORACLES["queue_while_busy"])
def queue_while_busy_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select("ts", "user_id", "event_id", "event_type", (F.col("event_id") % 3).alias("item"), (F.col("event_id") % 5).alias("q"))
    out = ordered.queued_while_busy(replayed(rows, "event_id"), ["user_id"], "ts", DELAY, "event_id", "event_type", "view", "purchase", "item", "q")
    return drained(out, "queue-while-busy")


@query(ORACLES["optimistic_count"])
def optimistic_count_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last of the counts that the stream gave for each user."""
    rows = events(spark, sf_dir).select("ts", "user_id", "event_id", (F.col("event_type") == "purchase").alias("form"), (F.col("event_id") % 5).alias("n"))
    out = ordered.optimistic_counts(replayed(rows, "event_id"), ["user_id"], "ts", DELAY, "event_id", "form", "n")
    return drained(out, "optimistic-count").groupBy("user_id").agg(F.max_by("count", F.struct("at", "event_id")).alias("count"))
