"""Event-time counts and sessions."""

from __future__ import annotations

import contextlib
import datetime as dt
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from martloom.functions.measures import count_if


def minute_counts(events: DataFrame, ts: str, delay: str = "10 minutes", size: str = "1 minute") -> DataFrame:
    """Events per tumbling window; a window comes out once the watermark has passed it."""
    return (
        events.withWatermark(ts, delay).groupBy(F.window(ts, size)).agg(F.count("*").alias("events"))
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "events")
    )


def sessions(events: DataFrame, user: str, ts: str, gap: str = "30 minutes", delay: str = "10 minutes") -> DataFrame:
    """Sessions closed by ``gap`` without an event; each comes out once the watermark has passed its end.

    Started within ``merged_in_tasks``, a query merges the sessions of each task before the shuffle, so a hot user sends
    sessions and not events.
    """
    return (
        events.withWatermark(ts, delay).groupBy(F.col(user), F.session_window(ts, gap))
        .agg(F.count("*").alias("events"), F.min(ts).alias("first_event"), F.max(ts).alias("last_event"))
        .drop("session_window")
    )


@contextlib.contextmanager
def merged_in_tasks(spark: SparkSession) -> Iterator[None]:
    """Session queries that start in here merge in two levels: intervals within a task, then by user. A query keeps the
    setting it started with, and so should be started like this on every restart."""
    name = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def dropped_late(query: StreamingQuery) -> int:
    """Rows the state operators left out because they came after the watermark."""
    return sum(
        op.get("numRowsDroppedByWatermark", 0)
        for progress in query.recentProgress for op in progress["stateOperators"]
    )


def freshness(ingested: DataFrame, event_time: str, load_time: str, now: dt.datetime, hours: int = 4,
              max_delay_seconds: int = 300) -> DataFrame:
    """Is the feed stalled, and how many rows came later than the allowed delay?"""
    stamp = F.lit(str(now)).cast("timestamp_ntz")
    recent = F.col(load_time) >= stamp - F.make_dt_interval(hours=F.lit(hours))
    delay = F.timestamp_diff("SECOND", F.col(event_time), F.col(load_time))
    return ingested.agg(
        F.max(load_time).alias("last_load"),
        count_if(recent).alias("recent_rows"),
        (count_if(recent) == 0).alias("is_stalled"),
        F.max(delay).alias("max_delay_seconds"),
        count_if(delay > max_delay_seconds).alias("delayed_rows"),
    )
