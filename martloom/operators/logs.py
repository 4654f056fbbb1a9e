"""Reports over run, usage, storage, login and task logs.

Logs are passed in; every report takes the present time as an argument.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions import dates as D
from martloom.functions.measures import count_if, pct
from martloom.operators.percentiles import exact_percentiles
from martloom.operators.shapes import top

# Money per credit and per TB and month, weeks per month.
CREDIT_PRICE, TB_PRICE, WEEKS_PER_MONTH = 3, 23, 4.29
MB, GB, TB = 1 << 20, 1 << 30, 1 << 40
# Credits per hour by size.
SIZE_RATES = {"X-Small": 1, "Small": 2, "Medium": 4, "Large": 8, "X-Large": 16}


def stamp(now: dt.datetime) -> Column:
    return F.lit(str(now)).cast("timestamp_ntz")


def since(log: DataFrame, column: str, now: dt.datetime, **back: float) -> DataFrame:
    return log.filter(F.col(column) > stamp(now - dt.timedelta(**back)))


def _scaled(column: str, unit: int) -> Column:
    return F.col(column) / unit


def slow(log: DataFrame, now: dt.datetime, days: int = 7, over_ms: int = 60_000, n: int = 50) -> DataFrame:
    rows = since(log, "start_time", now, days=days).filter(F.col("execution_time") > over_ms)
    return top(rows, [F.desc("execution_time"), F.asc("query_id")], n).select(
        "query_id", "query_text", "user_name", "resource_name", _scaled("execution_time", 1000).alias("execution_sec"),
        _scaled("bytes_scanned", GB).alias("gb_scanned"), "rows_produced", "partitions_scanned", "partitions_total",
        pct(F.col("partitions_scanned"), F.col("partitions_total")).alias("partition_scan_pct"),
        _scaled("bytes_spilled_local", MB).alias("mb_spilled_local"),
        _scaled("bytes_spilled_remote", MB).alias("mb_spilled_remote"), "query_type", "start_time")


def by_user(log: DataFrame, now: dt.datetime, days: int = 7) -> DataFrame:
    ms = F.col("execution_time")
    return since(log, "start_time", now, days=days).groupBy("user_name").agg(
        F.count("*").alias("query_count"), (F.sum(ms) / 60_000).alias("total_minutes"),
        (F.avg(ms) / 1000).alias("avg_seconds"), (F.max(ms) / 1000).alias("max_seconds"),
        F.sum("cloud_credits").alias("cloud_credits"))


def hourly(log: DataFrame, now: dt.datetime, days: int = 1) -> DataFrame:
    recent = since(log, "start_time", now, days=days).filter(F.col("resource_name").isNotNull())
    return recent.groupBy("resource_name", F.date_trunc("hour", "start_time").cast("timestamp_ntz").alias("hour")).agg(
        F.count("*").alias("query_count"), (F.avg("execution_time") / 1000).alias("avg_execution_sec"),
        F.sum("credits_used").alias("total_credits"), (F.avg("queued_ms") / 1000).alias("avg_queue_sec"))


def cache_rate(log: DataFrame, now: dt.datetime, days: int = 7) -> DataFrame:
    reads = since(log, "start_time", now, days=days).filter(F.col("query_type") == "SELECT")
    hit = F.col("bytes_scanned") == 0
    return reads.groupBy(F.to_date("start_time").alias("query_date")).agg(
        F.count("*").alias("total_queries"), count_if(hit).alias("result_cache_hits"),
        pct(count_if(hit), F.count("*")).alias("cache_hit_pct"))


def poor_pruning(log: DataFrame, now: dt.datetime, days: int = 7, least: int = 100, n: int = 20) -> DataFrame:
    scanned, total = F.col("partitions_scanned"), F.col("partitions_total")
    rows = since(log, "start_time", now, days=days).filter((total > least) & (scanned * 2 > total))
    return top(rows, [F.desc("partitions_scanned"), F.asc("query_id")], n).select(
        "query_id", "query_text", "partitions_scanned", "partitions_total", pct(scanned, total).alias("scan_pct"))


def spills(log: DataFrame, now: dt.datetime, days: int = 7, n: int = 20) -> DataFrame:
    rows = since(log, "start_time", now, days=days).filter("bytes_spilled_local > 0 OR bytes_spilled_remote > 0")
    return top(rows, [F.desc("bytes_spilled_remote"), F.asc("query_id")], n).select(
        "query_id", "query_text", "resource_size", _scaled("bytes_spilled_local", GB).alias("gb_spilled_local"),
        _scaled("bytes_spilled_remote", GB).alias("gb_spilled_remote"))


def daily_metrics(log: DataFrame, now: dt.datetime, days: int = 30) -> DataFrame:
    ms = F.col("execution_time")
    return since(log, "start_time", now, days=days).groupBy(
        F.to_date("start_time").alias("query_date"), "resource_name").agg(
        F.count("*").alias("query_count"), (F.sum(ms) / 60_000).alias("total_minutes"),
        (F.avg(ms) / 1000).alias("avg_seconds"), F.sum("credits_used").alias("total_credits"),
        (F.sum("bytes_scanned") / TB).alias("tb_scanned"))


def percentiles(log: DataFrame, by: str | None = None) -> DataFrame:
    """Exact p50, p95 and p99 of the run time, per value of ``by`` or over all."""
    wanted = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    return exact_percentiles(log, [by] if by else [], "execution_time", wanted)


def exports(log: DataFrame, now: dt.datetime, pattern: str = "%COPY INTO%@%", days: int = 30, n: int = 50) -> DataFrame:
    rows = since(log, "start_time", now, days=days).filter(F.col("query_text").ilike(pattern))
    return top(rows, [F.desc("start_time"), F.asc("query_id")], n).select(
        "user_name", "query_type", "query_text", "start_time")


def failed(log: DataFrame, now: dt.datetime, hours: int = 1) -> DataFrame:
    rows = since(log, "start_time", now, hours=hours).filter(F.col("error_code").isNotNull())
    return rows.select("query_id", "error_code", "error_message", "query_text", "start_time").orderBy(
        F.desc("start_time"), "query_id").drop("start_time")


def top_consumers(log: DataFrame, now: dt.datetime, days: int = 7) -> DataFrame:
    return since(log, "start_time", now, days=days).groupBy("resource_name").agg(
        F.round(F.sum("credits_used"), 2).alias("credits"))


# Usage and cost

def cost_daily(usage: DataFrame, now: dt.datetime, days: int = 30) -> DataFrame:
    return since(usage, "start_time", now, days=days).groupBy(
        "resource_name", F.to_date("start_time").alias("usage_date")).agg(
        F.sum("credits_used").alias("total_credits"), F.sum("compute_credits").alias("compute_credits"),
        F.sum("cloud_credits").alias("cloud_service_credits"), F.count("*").alias("query_count"))


def cost_total(usage: DataFrame, now: dt.datetime, days: int = 30) -> DataFrame:
    credits = F.sum("credits_used")
    return since(usage, "start_time", now, days=days).groupBy("resource_name").agg(
        F.round(credits, 2).alias("total_credits_30d"), F.round(credits * CREDIT_PRICE, 2).alias("estimated_cost_30d"),
        F.round(F.avg("credits_used"), 4).alias("avg_credits_per_hour"),
        F.min("start_time").alias("first_usage"), F.max("end_time").alias("last_usage"))


def storage_daily(storage: DataFrame, now: dt.datetime, days: int = 30) -> DataFrame:
    recent = storage.filter(F.col("usage_date") > D.day((now - dt.timedelta(days=days)).date()))
    total = F.col("storage_bytes") + F.col("stage_bytes") + F.col("failsafe_bytes")
    return recent.select(
        "usage_date", *[F.round(_scaled(f"{p}_bytes", TB), 4).alias(f"{p}_tb") for p in ("storage", "stage", "failsafe")],
        F.round(total / TB, 4).alias("total_tb"), F.round(total / TB * TB_PRICE, 2).alias("estimated_cost"))


def storage_by_schema(tables: DataFrame) -> DataFrame:
    every = F.sum(F.col("active_bytes") + F.col("time_travel_bytes") + F.col("failsafe_bytes"))
    return tables.filter(F.col("deleted").isNull()).groupBy("database_name", "schema_name").agg(
        F.count("*").alias("table_count"),
        *[F.round(F.sum(f"{p}_bytes") / GB, 2).alias(f"{p}_gb") for p in ("active", "time_travel", "failsafe")],
        F.round(every / GB, 2).alias("total_gb"))


def cost_union(parts: Mapping[str, DataFrame], now: dt.datetime, days: int = 90) -> DataFrame:
    """Usage logs of one shape (``resource_name, start_time, credits_used``), by day and category."""
    out = None
    for category, usage in parts.items():
        part = since(usage, "start_time", now, days=days).groupBy(
            F.to_date("start_time").alias("cost_date"), F.lit(category).alias("cost_category"), "resource_name").agg(
            F.sum("credits_used").alias("credits"))
        out = part if out is None else out.unionByName(part)
    return out


def service_usage(usage: DataFrame, now: dt.datetime, measure: str, unit_name: str, days: int = 30,
                  counter: str | None = None) -> DataFrame:
    """Background service usage per resource and day, with its volume in GB."""
    extra = [F.sum(counter).alias(counter)] if counter else []
    return since(usage, "start_time", now, days=days).groupBy(
        "resource_name", F.to_date("start_time").alias("usage_date")).agg(
        F.sum("credits_used").alias("credits_used"), *extra, (F.sum(measure) / GB).alias(unit_name))


def cost_idle(usage: DataFrame, now: dt.datetime, days: int = 7) -> DataFrame:
    idle = F.col("queries_executed") == 0
    wasted = F.round(F.sum(F.when(idle, F.col("credits_used")).otherwise(0)), 2)
    return since(usage, "start_time", now, days=days).groupBy("resource_name").agg(
        F.count("*").alias("hours_active"), F.sum("credits_used").alias("total_credits"),
        count_if(idle).alias("idle_hours"), wasted.alias("wasted_credits")).filter("wasted_credits > 0")


def cost_downsize(log: DataFrame, now: dt.datetime, days: int = 7) -> DataFrame:
    recent = since(log, "start_time", now, days=days).filter(F.col("resource_name").isNotNull())
    return recent.groupBy("resource_name", "resource_size").agg(
        F.count("*").alias("query_count"), (F.avg("execution_time") / 1000).alias("avg_execution_sec"),
        (F.max("execution_time") / 1000).alias("max_execution_sec"),
        F.sum("bytes_spilled_local").alias("bytes_spilled_local"),
        F.sum("bytes_spilled_remote").alias("bytes_spilled_remote"))


def cost_projection(usage: DataFrame, now: dt.datetime, days: int = 30) -> DataFrame:
    daily = since(usage, "start_time", now, days=days).groupBy(F.to_date("start_time").alias("d")).agg(
        F.sum("credits_used").alias("c"))
    mean = F.sum("c") / F.count("c")
    return daily.agg(F.round(mean, 4).alias("avg_daily_credits"),
                     F.round(mean * 30, 4).alias("projected_monthly_credits"),
                     F.round(mean * 30 * CREDIT_PRICE, 4).alias("projected_monthly_cost_usd"))


def search_cost(usage: DataFrame, now: dt.datetime, days: int = 7) -> DataFrame:
    credits = F.sum("credits_used")
    rate = F.lit(WEEKS_PER_MONTH).cast("decimal(4,2)")
    return since(usage, "start_time", now, days=days).groupBy("table_name").agg(
        credits.alias("total_credits_7d"), F.round(credits * rate, 2).alias("estimated_monthly_credits"))


# Logins, tasks, benchmark

def failed_logins(logins: DataFrame, now: dt.datetime, days: int = 7, n: int = 50) -> DataFrame:
    rows = since(logins, "event_timestamp", now, days=days).filter(F.col("is_success") == "NO")
    return top(rows, [F.desc("event_timestamp"), F.asc("user_name")], n).select(
        "user_name", "client_ip", "is_success", "error_code", "error_message", "event_timestamp")


def logins_by_address(logins: DataFrame, now: dt.datetime, days: int = 30) -> DataFrame:
    good = since(logins, "event_timestamp", now, days=days).filter(F.col("is_success") == "YES")
    return good.groupBy("client_ip").agg(
        F.count("*").alias("login_count"), F.countDistinct("user_name").alias("unique_users"),
        F.min("event_timestamp").alias("first_login"), F.max("event_timestamp").alias("last_login"))


def task_health(tasks: DataFrame, now: dt.datetime, days: int = 1) -> DataFrame:
    state = F.col("state")
    return since(tasks, "scheduled_time", now, days=days).agg(
        F.lit("Tasks").alias("component"), F.count("*").alias("total"),
        count_if(state == "SUCCEEDED").alias("healthy"), count_if(state == "FAILED").alias("issues"))


def perf_report(benchmark: DataFrame) -> DataFrame:
    def mb(column: str) -> Column:
        return F.round(_scaled(column, MB), 2)

    advice = (
        F.when(F.col("bytes_spilled_remote") > 0, "NEEDS_LARGER_WAREHOUSE")
        .when(F.col("pruning_pct") < 50, "NEEDS_CLUSTERING")
        .when(F.col("execution_time_ms") > 60_000, "NEEDS_OPTIMIZATION").otherwise("OK"))
    return benchmark.select(
        "test_name", "test_category", "warehouse_size", "execution_time_ms", "rows_returned",
        mb("bytes_scanned").alias("mb_scanned"), "partitions_scanned", "partitions_total", "pruning_pct",
        mb("bytes_spilled_local").alias("mb_spilled_local"), mb("bytes_spilled_remote").alias("mb_spilled_remote"),
        advice.alias("recommendation"), "test_timestamp")


def size_benchmark(log: DataFrame, now: dt.datetime, text: str, days: int = 7, n: int = 10) -> DataFrame:
    """Newest runs of a statement with what they cost at the rate of their size."""
    rate = F.lit(None).cast("int")
    for size, credits in SIZE_RATES.items():
        rate = F.when(F.col("resource_size") == size, credits).otherwise(rate)
    rows = since(log, "start_time", now, days=days).filter(F.col("query_text").contains(text))
    return top(rows, [F.desc("start_time"), F.asc("query_id")], n).select(
        F.col("resource_size").alias("warehouse_size"), F.col("execution_time").alias("execution_ms"),
        F.round(F.col("execution_time").cast("decimal(18,0)") * rate / 3_600_000, 4).alias("credits_used"))


# Alerts

def _alert(rows: DataFrame, name: str, value: Column, fired) -> DataFrame:
    one = rows.agg(value.cast("double").alias("value"))
    return one.select(F.lit(name).alias("alert"), F.coalesce(fired(F.col("value")), F.lit(False)).alias("fired"),
                      "value")


def alerts(tasks: DataFrame, fact: DataFrame, quality_log: DataFrame, log: DataFrame, usage: DataFrame,
           loads: DataFrame, now: dt.datetime) -> DataFrame:
    """One row per condition: did it fire, and the value it looked at."""
    count = F.count("*")
    queued = since(log, "start_time", now, minutes=30).filter(F.col("queued_ms") > 30_000).groupBy(
        "resource_name").agg(F.count("*").alias("n"))
    stale_hours = F.timestamp_diff("SECOND", F.max("load_timestamp"), stamp(now)) / 3600
    today = usage.filter(F.to_date("start_time") == D.day(now.date()))
    parts = [
        _alert(since(tasks, "scheduled_time", now, minutes=15).filter("state = 'FAILED'"), "TASK_FAILURE", count,
               lambda v: v > 0),
        _alert(fact, "DATA_FRESHNESS", stale_hours, lambda v: v > 6),
        _alert(quality_log.filter((F.col("validation_timestamp") >= stamp(now - dt.timedelta(days=1)))
                                  & (F.col("status") == "FAIL")), "DQ_FAILURE", count, lambda v: v > 0),
        _alert(queued, "QUEUING", F.max("n"), lambda v: v > 5),
        _alert(today, "HIGH_USAGE_TODAY", F.sum("credits_used"), lambda v: v > 50),
        _alert(since(loads, "last_load_time", now, hours=4), "NO_FILES_LOADED", count, lambda v: v == 0),
        _alert(since(usage, "start_time", now, days=1), "USAGE_THRESHOLD", F.sum("credits_used"), lambda v: v > 20),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
