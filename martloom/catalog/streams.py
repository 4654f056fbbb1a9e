"""Streaming jobs, run over files until all are read."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from martloom.catalog.history import CLICK_FACT, CLICKS, click_calendar, staged_clicks
from martloom.catalog.oracle import star
from martloom.catalog.registry import query
from martloom.functions import dates as D
from martloom.functions.variants import path as at
from martloom.plans.star import customer_hash
from martloom.schemas import TABLES
from martloom.session import scratch_path
from martloom.sources import sinks
from martloom.streaming import clickstream, ingest, tables, windows

EVENTS = TABLES["events"]


def _events_stream(s):
    """The given events file as a stream."""
    return ingest.source(s.spark, s.folder, EVENTS, glob="events.parquet")


def _paths(s, label):
    root = scratch_path(s.spark, label)
    return f"{root}/in", f"{root}/out", f"{root}/checkpoint"


def _run_twice(start):
    """Runs to the end, then again on the same checkpoint: the second run must add nothing."""
    for _again in range(2):
        start().awaitTermination()


@query("stream_ingest", "SELECT event_id, ts, user_id, event_type, TRUE AS has_source FROM events")
def _(s):
    _in, out, checkpoint = _paths(s, "stream-ingest")
    _run_twice(lambda: ingest.ingest(s.spark, s.folder, EVENTS, out, checkpoint, glob="events.parquet"))
    return s.spark.read.parquet(out).select(
        "event_id", "ts", "user_id", "event_type", F.col("_source_file").endswith("events.parquet").alias("has_source"))


@query("cdc_append", "SELECT event_id, event_type FROM events")
def _(s):
    _in, out, checkpoint = _paths(s, "cdc-append")
    _run_twice(lambda: ingest.start(_events_stream(s).select("event_id", "event_type"), out, checkpoint))
    return s.spark.read.schema("event_id bigint, event_type string").parquet(out)


@query("cdc_consume", "SELECT event_id, user_id FROM events")
def _(s):
    _in, out, checkpoint = _paths(s, "cdc-consume")
    _run_twice(lambda: ingest.consume(_events_stream(s).select("event_id", "user_id"), out, checkpoint))
    return s.spark.read.parquet(out).select("event_id", "user_id")


@query("cdc_fanout", """
SELECT 'all' AS consumer, COUNT(*) AS n FROM events
UNION ALL SELECT 'purchases', COUNT(*) FROM events WHERE event_type = 'purchase'""")
def _(s):
    out = None
    for name, condition in (("all", "true"), ("purchases", "event_type = 'purchase'")):
        _in, target, checkpoint = _paths(s, f"fanout-{name}")
        feed = _events_stream(s).filter(condition).select("event_id")
        ingest.consume(feed, target, checkpoint).awaitTermination()
        part = s.spark.read.parquet(target).agg(F.count("*").alias("n")).select(F.lit(name).alias("consumer"), "n")
        out = part if out is None else out.unionByName(part)
    return out


def _in_order(s, path, with_repeats=False):
    """The events as two files, in time order, then one far-future event that closes every window."""
    events = s.events
    middle = F.lit("2024-01-15").cast("timestamp_ntz")
    first = events.filter(F.col("ts") < middle)
    if with_repeats:
        first = first.unionByName(first.filter("event_id % 10 = 0"))
    first.write.mode("append").parquet(path)
    yield
    events.filter(F.col("ts") >= middle).write.mode("append").parquet(path)
    yield
    last = events.limit(1).select(
        F.lit(-1).cast("bigint").alias("event_id"), F.lit("2030-01-01").cast("timestamp_ntz").alias("ts"),
        F.lit(-1).cast("bigint").alias("user_id"), F.lit("end").alias("event_type"), F.lit(0.0).alias("value"),
        F.lit("{}").alias("props"))
    last.write.mode("append").parquet(path)
    yield


def _timed(events):
    """Event time as a zoned timestamp, which windows and watermarks need."""
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


@query("stream_dedup", "SELECT event_id, user_id FROM events")
def _(s):
    path, out, checkpoint = _paths(s, "stream-dedup")
    for _step in _in_order(s, path, with_repeats=True):
        unique = ingest.deduplicate(_timed(ingest.source(s.spark, path, EVENTS)), "event_id", "ts", "2 days")
        ingest.start(unique.select("event_id", "user_id"), out, checkpoint).awaitTermination()
    return s.spark.read.parquet(out).filter("event_id >= 0")


@query("stream_minute_counts", """
SELECT date_trunc('minute', ts) AS window_start, date_trunc('minute', ts) + INTERVAL 1 MINUTE AS window_end,
  COUNT(*) AS events FROM events GROUP BY 1""")
def _(s):
    path, out, checkpoint = _paths(s, "stream-minutes")
    for _step in _in_order(s, path):
        counts = windows.minute_counts(_timed(ingest.source(s.spark, path, EVENTS)), "ts")
        ingest.start(counts, out, checkpoint).awaitTermination()
    done = s.spark.read.parquet(out)
    return done.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                       F.col("window_end").cast("timestamp_ntz").alias("window_end"), "events")


@query("stream_sessions", """
WITH f AS (SELECT *, CASE WHEN ts - LAG(ts) OVER w < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS starts
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
n AS (SELECT *, SUM(starts) OVER (PARTITION BY user_id ORDER BY ts) AS session FROM f)
SELECT user_id, COUNT(*) AS events, MIN(ts) AS first_event, MAX(ts) AS last_event FROM n GROUP BY user_id, session""")
def _(s):
    path, out, checkpoint = _paths(s, "stream-sessions")
    for _step in _in_order(s, path):
        found = windows.sessions(_timed(ingest.source(s.spark, path, EVENTS)), "user_id", "ts")
        with windows.merged_in_tasks(s.spark):
            ingest.start(found, out, checkpoint).awaitTermination()
    done = s.spark.read.parquet(out).filter("user_id >= 0")
    return done.select("user_id", "events", F.col("first_event").cast("timestamp_ntz").alias("first_event"),
                       F.col("last_event").cast("timestamp_ntz").alias("last_event"))


@query("stream_clickstream_fact", CLICKS)
def _(s):
    _in, out, checkpoint = _paths(s, "stream-clicks")
    staged = staged_clicks(_events_stream(s), s)
    _run_twice(lambda: tables.clickstream_fact(staged, lambda: click_calendar(s), lambda: s.dim_customer, out,
                                               checkpoint))
    return s.spark.read.parquet(out).select(*CLICK_FACT)


@query("stream_scd1", star("""
SELECT customer_id, segment FROM customer_new
UNION ALL SELECT customer_id, segment FROM customer_old WHERE c_custkey % 97 = 0"""))
def _(s):
    path, base, checkpoint = _paths(s, "stream-scd1")
    s.customer_new.withColumn("seq", F.lit(1)).write.parquet(path)
    schema = "customer_id string, c_custkey bigint, c_name string, c_nationkey int, balance decimal(12,2), " \
             "segment string, seq int"
    changes = ingest.source(s.spark, path, schema)
    sets = ["c_name", "c_nationkey", "balance", "segment"]
    _run_twice(lambda: tables.keep_scd1(changes, base, s.customer_old, ["customer_id"], sets, [F.desc("seq")],
                                        checkpoint))
    return sinks.get_batch(s.spark, base).select("customer_id", "segment")


@query("stream_scd2", star("""
SELECT o.customer_id, o.segment, DATE '2001-01-01' AS effective_date,
  CASE WHEN n.segment <> o.segment THEN DATE '2001-07-30' END AS end_date,
  NOT COALESCE(n.segment <> o.segment, FALSE) AS is_current
FROM customer_old o LEFT JOIN customer_new n USING (customer_id)
UNION ALL SELECT n.customer_id, n.segment, DATE '2001-07-31', NULL, TRUE
FROM customer_new n LEFT JOIN customer_old o USING (customer_id) WHERE o.customer_id IS NULL OR o.segment <> n.segment
"""))
def _(s):
    path, base, checkpoint = _paths(s, "stream-scd2")
    s.customer_new.withColumn("record_hash", customer_hash()).write.parquet(path)
    schema = "customer_id string, c_custkey bigint, c_name string, c_nationkey int, balance decimal(12,2), " \
             "segment string, record_hash string"
    initial = s.customer_old.withColumn("record_hash", customer_hash()).select(
        F.col("c_custkey").alias("customer_key"), *s.customer_old.columns, "record_hash",
        D.day("2001-01-01").alias("effective_date"), F.lit(None).cast("date").alias("end_date"),
        F.lit(True).alias("is_current"))
    changes = ingest.source(s.spark, path, schema)
    _run_twice(lambda: tables.keep_scd2(
        changes, base, initial, "customer_id", "record_hash", "customer_key",
        lambda batch: s.as_of + dt.timedelta(days=batch), [F.asc("segment")], checkpoint))
    return sinks.get_batch(s.spark, base).select("customer_id", "segment", "effective_date", "end_date", "is_current")


@query("stream_late", star("""
, base AS (SELECT order_id, order_line_id, product_key, store_key, quantity, net_amount, load_timestamp, 0 AS late,
    CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS month FROM fact_lines JOIN orders ON o_orderkey = order_id),
every AS (SELECT * FROM base UNION ALL SELECT * REPLACE (quantity + 100 AS quantity, 1 AS late) FROM base
  WHERE order_id % 20 = 0)
SELECT order_id, order_line_id, quantity, month FROM every
QUALIFY ROW_NUMBER() OVER (PARTITION BY order_id, order_line_id ORDER BY late DESC, load_timestamp DESC, product_key,
  store_key, quantity, net_amount) = 1"""))
def _(s):
    path, base, checkpoint = _paths(s, "stream-late")
    stamp = F.col("transaction_timestamp")
    lines = s.fact_sales.select(
        "order_id", "order_line_id", "product_key", "store_key", "quantity", "net_amount", "load_timestamp",
        (F.year(stamp) * 100 + F.month(stamp)).alias("month"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in lines.schema.fields)
    order = [F.desc("load_timestamp"), F.asc("product_key"), F.asc("store_key"), F.asc("quantity"),
             F.asc("net_amount")]
    late = lines.filter("order_id % 20 = 0").withColumn("quantity", F.col("quantity") + 100)
    for part in (lines, late):
        part.write.mode("append").parquet(path)
        tables.keep_facts(ingest.source(s.spark, path, schema), base, ["order_id", "order_line_id"], order, "month",
                          checkpoint).awaitTermination()
    return sinks.get_batch(s.spark, base).select("order_id", "order_line_id", "quantity", "month")


@query("stream_bad_records", """
SELECT CASE WHEN event_id % 200 = 3 THEN 'bad' ELSE 'good' END AS sink, COUNT(*) AS n,
  SUM(CASE WHEN event_id % 200 = 3 THEN 0 ELSE event_id END)::BIGINT AS id_sum FROM events GROUP BY 1""")
def _(s):
    path, out, checkpoint = _paths(s, "stream-bad")
    text = F.to_json(F.struct("event_id", "event_type"))
    broken = F.when(F.col("event_id") % 200 == 3, F.concat(text, F.lit("}"))).otherwise(text)
    s.events.select(broken.alias("value")).write.text(path)
    lines = ingest.source(s.spark, path, "value string", "text")
    ingest.split_bad_records(lines, "value", f"{out}/good", f"{out}/bad", checkpoint).awaitTermination()
    good = s.spark.read.parquet(f"{out}/good").select(
        F.lit("good").alias("sink"), at(F.col("raw_json"), "event_id", "bigint").alias("id"))
    bad = s.spark.read.parquet(f"{out}/bad").select(F.lit("bad").alias("sink"), F.lit(0).cast("bigint").alias("id"))
    return good.unionByName(bad).groupBy("sink").agg(F.count("*").alias("n"), F.sum("id").alias("id_sum"))


@query("stream_freshness", """
SELECT MAX(l) AS last_load, COUNT(*) FILTER (l >= TIMESTAMP '2024-01-30 08:00:00') AS recent_rows,
  COUNT(*) FILTER (l >= TIMESTAMP '2024-01-30 08:00:00') = 0 AS is_stalled, MAX(s) AS max_delay_seconds,
  COUNT(*) FILTER (s > 300) AS delayed_rows
FROM (SELECT ts + INTERVAL 1 SECOND * (event_id % 400) AS l, CAST(event_id % 400 AS BIGINT) AS s FROM events)""")
def _(s):
    wait = F.make_dt_interval(secs=(F.col("event_id") % 400).cast("decimal(18,6)"))
    loaded = s.events.withColumn("loaded", F.col("ts") + wait)
    return windows.freshness(loaded, "ts", "loaded", dt.datetime(2024, 1, 30, 12))


@query("stream_clickstream_job", """
SELECT 'fact' AS sink, event_id::VARCHAR AS event_id,
  CASE WHEN CAST(ts AS DATE) <= DATE '2024-01-28' THEN CAST(strftime(ts, '%Y%m%d') AS INTEGER) END AS date_key,
  c_custkey AS customer_key, NULL AS rejection_reason
FROM events LEFT JOIN customer ON c_custkey = user_id AND event_id % 10 <> 0 WHERE event_id % 200 <> 3 AND event_id % 50 <> 7
UNION ALL SELECT 'bad', CASE WHEN event_id % 200 <> 3 THEN event_id::VARCHAR END, NULL, NULL,
  CASE WHEN event_id % 200 = 3 THEN 'malformed JSON' ELSE 'Failed validation' END
FROM events WHERE event_id % 200 = 3 OR event_id % 50 = 7""")
def _(s):
    """Lines of which some are broken, some lack a session and some come twice; the first run dies before its commit."""
    path, out, checkpoint = _paths(s, "stream-click-job")
    e = F.col("event_id")
    document = F.to_json(F.struct(
        e.cast("string").alias("event_id"), F.when(e % 50 != 7, F.concat(F.lit("S"), "user_id")).alias("session_id"),
        F.when(e % 10 != 0, F.concat(F.lit("CUST-"), "user_id")).alias("customer_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("event_timestamp"), "event_type"))
    texts = s.events.select(F.when(e % 200 == 3, F.concat(document, F.lit("}"))).otherwise(document).alias("value"), e.alias("id"))
    texts.select("value").write.mode("append").text(path)
    texts.filter("id % 9 = 0 AND id % 200 <> 3").select("value").write.mode("append").text(path)
    lines = lambda: ingest.source(s.spark, path, "value string", "text")

    def broken():
        raise RuntimeError("the dimension cannot be read")

    first = clickstream.clickstream(lines(), out, lambda: click_calendar(s), broken, checkpoint, "400 days")
    try:
        first.awaitTermination()
    except Exception as error:
        if "the dimension cannot be read" not in str(error):
            raise
    _run_twice(lambda: clickstream.clickstream(lines(), out, lambda: click_calendar(s), lambda: s.dim_customer, checkpoint, "400 days"))
    good = clickstream.facts_of(s.spark, out).select(
        F.lit("fact").alias("sink"), "event_id", "date_key", "customer_key", F.lit(None).cast("string").alias("rejection_reason"))
    bad = clickstream.rows_of(s.spark, out, clickstream.BAD).select(
        F.lit("bad").alias("sink"), "event_id", F.lit(None).cast("int").alias("date_key"),
        F.lit(None).cast("bigint").alias("customer_key"), "rejection_reason")
    return good.unionByName(bad)
