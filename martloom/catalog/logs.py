"""Log, cost, lineage and alert reports, with the events as the log."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from martloom.catalog.registry import query
from martloom.functions import variants
from martloom.operators import lineage as G
from martloom.operators import logs as L

NOW = dt.datetime(2024, 1, 30, 12)

_LOG = """WITH e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events), log AS (
  SELECT event_id AS query_id, user_id, k, ts,
    CASE event_type WHEN 'purchase' THEN 'copy into @out from FACT_SALES' ELSE 'select ' || event_type END AS query_text,
    'U' || user_id AS user_name, event_type AS resource_name,
    (['X-Small', 'Small', 'Medium', 'Large', 'X-Large'])[1 + user_id % 5] AS resource_size,
    CAST(FLOOR(value * 4000) AS BIGINT) AS execution_time, (k // 10) * 536870912 AS bytes_scanned, k * 3 AS rows_produced,
    k AS partitions_scanned, k + event_id % 120 AS partitions_total,
    CASE WHEN k > 90 THEN k * 1048576 ELSE 0 END AS bytes_spilled_local,
    CASE WHEN k > 96 THEN k * 524288 ELSE 0 END AS bytes_spilled_remote,
    CASE WHEN event_id % 3 = 0 THEN 'INSERT' ELSE 'SELECT' END AS query_type, ts AS start_time,
    ts + INTERVAL 1 HOUR AS end_time, CAST(k * 0.01 AS DECIMAL(10,4)) AS credits_used,
    CAST(k * 0.008 AS DECIMAL(10,4)) AS compute_credits, CAST(k * 0.002 AS DECIMAL(10,4)) AS cloud_credits,
    k * 500 AS queued_ms, CASE WHEN event_type = 'error' THEN k END AS error_code,
    CASE WHEN event_type = 'error' THEN 'error ' || k END AS error_message,
    CASE WHEN k % 4 = 0 THEN 0 ELSE k END AS queries_executed,
    CASE event_type WHEN 'error' THEN 'FAILED' ELSE 'SUCCEEDED' END AS state
  FROM e)
"""
_WEEK, _MONTH, _DAY = (f"start_time > TIMESTAMP '{t}'" for t in (
    "2024-01-23 12:00:00", "2023-12-31 12:00:00", "2024-01-29 12:00:00"))


def run_log(s):
    """The events as a run log."""
    k = F.col("k")
    events = s.events.withColumn("k", variants.path(F.parse_json("props"), "k", "bigint"))
    sizes = F.array(*[F.lit(x) for x in L.SIZE_RATES])
    kind = F.col("event_type")

    def credits(rate):
        return (k.cast("decimal(10,0)") * F.lit(rate).cast("decimal(6,4)")).cast("decimal(10,4)")

    return events.select(
        F.col("event_id").alias("query_id"), "user_id", "k", "ts",
        F.when(kind == "purchase", "copy into @out from FACT_SALES").otherwise(
            F.concat(F.lit("select "), kind)).alias("query_text"),
        F.concat(F.lit("U"), "user_id").alias("user_name"), kind.alias("resource_name"),
        F.get(sizes, (F.col("user_id") % 5).cast("int")).alias("resource_size"),
        F.floor(F.col("value") * 4000).alias("execution_time"),
        (F.floor(k / 10) * 536870912).alias("bytes_scanned"), (k * 3).alias("rows_produced"),
        k.alias("partitions_scanned"), (k + F.col("event_id") % 120).alias("partitions_total"),
        F.when(k > 90, k * 1048576).otherwise(0).alias("bytes_spilled_local"),
        F.when(k > 96, k * 524288).otherwise(0).alias("bytes_spilled_remote"),
        F.when(F.col("event_id") % 3 == 0, "INSERT").otherwise("SELECT").alias("query_type"),
        F.col("ts").alias("start_time"), (F.col("ts") + F.make_dt_interval(hours=F.lit(1))).alias("end_time"),
        credits("0.01").alias("credits_used"), credits("0.008").alias("compute_credits"),
        credits("0.002").alias("cloud_credits"), (k * 500).alias("queued_ms"),
        F.when(kind == "error", k).alias("error_code"),
        F.when(kind == "error", F.concat(F.lit("error "), k)).alias("error_message"),
        F.when(k % 4 == 0, 0).otherwise(k).alias("queries_executed"),
        F.when(kind == "error", "FAILED").otherwise("SUCCEEDED").alias("state"))


@query("log_slow", _LOG + f"""
SELECT query_id, query_text, user_name, resource_name, execution_time / 1000 AS execution_sec,
  bytes_scanned / 1073741824 AS gb_scanned, rows_produced, partitions_scanned, partitions_total,
  ROUND(partitions_scanned / NULLIF(partitions_total, 0) * 100, 2) AS partition_scan_pct,
  bytes_spilled_local / 1048576 AS mb_spilled_local, bytes_spilled_remote / 1048576 AS mb_spilled_remote,
  query_type, start_time
FROM log WHERE {_WEEK} AND execution_time > 60000 ORDER BY execution_time DESC, query_id LIMIT 50""")
def _(s):
    return L.slow(run_log(s), NOW)


@query("log_by_user", _LOG + f"""
SELECT user_name, COUNT(*) AS query_count, SUM(execution_time) / 60000 AS total_minutes,
  AVG(execution_time) / 1000 AS avg_seconds, MAX(execution_time) / 1000 AS max_seconds,
  CAST(SUM(cloud_credits) AS DOUBLE) AS cloud_credits FROM log WHERE {_WEEK} GROUP BY 1""")
def _(s):
    return L.by_user(run_log(s), NOW)


@query("log_hourly", _LOG + f"""
SELECT resource_name, date_trunc('hour', start_time) AS hour, COUNT(*) AS query_count,
  AVG(execution_time) / 1000 AS avg_execution_sec, CAST(SUM(credits_used) AS DOUBLE) AS total_credits,
  AVG(queued_ms) / 1000 AS avg_queue_sec FROM log WHERE {_DAY} GROUP BY ALL""")
def _(s):
    return L.hourly(run_log(s), NOW)


@query("log_cache_rate", _LOG + f"""
SELECT CAST(start_time AS DATE) AS query_date, COUNT(*) AS total_queries,
  COUNT(*) FILTER (bytes_scanned = 0) AS result_cache_hits,
  ROUND(COUNT(*) FILTER (bytes_scanned = 0) / COUNT(*) * 100, 2) AS cache_hit_pct
FROM log WHERE {_WEEK} AND query_type = 'SELECT' GROUP BY 1""")
def _(s):
    return L.cache_rate(run_log(s), NOW)


@query("log_poor_pruning", _LOG + f"""
SELECT query_id, query_text, partitions_scanned, partitions_total,
  ROUND(partitions_scanned / partitions_total * 100, 2) AS scan_pct
FROM log WHERE {_WEEK} AND partitions_total > 100 AND partitions_scanned / partitions_total > 0.5
ORDER BY partitions_scanned DESC, query_id LIMIT 20""")
def _(s):
    return L.poor_pruning(run_log(s), NOW)


@query("log_spills", _LOG + f"""
SELECT query_id, query_text, resource_size, bytes_spilled_local / 1073741824 AS gb_spilled_local,
  bytes_spilled_remote / 1073741824 AS gb_spilled_remote
FROM log WHERE {_WEEK} AND bytes_spilled_local + bytes_spilled_remote > 0
ORDER BY bytes_spilled_remote DESC, query_id LIMIT 20""")
def _(s):
    return L.spills(run_log(s), NOW)


@query("log_daily_metrics", _LOG + f"""
SELECT CAST(start_time AS DATE) AS query_date, resource_name, COUNT(*) AS query_count,
  SUM(execution_time) / 60000 AS total_minutes, AVG(execution_time) / 1000 AS avg_seconds,
  CAST(SUM(credits_used) AS DOUBLE) AS total_credits, SUM(bytes_scanned) / 1099511627776 AS tb_scanned
FROM log WHERE {_MONTH} GROUP BY ALL""")
def _(s):
    return L.daily_metrics(run_log(s), NOW)


@query("log_percentiles", _LOG + """
SELECT quantile_cont(execution_time, 0.5) AS p50, quantile_cont(execution_time, 0.95) AS p95,
  quantile_cont(execution_time, 0.99) AS p99 FROM log""")
def _(s):
    return L.percentiles(run_log(s))


@query("log_percentiles_by_resource", _LOG + """
SELECT resource_name, ROUND(quantile_cont(execution_time, 0.5), 4) AS p50,
  ROUND(quantile_cont(execution_time, 0.95), 4) AS p95, ROUND(quantile_cont(execution_time, 0.99), 4) AS p99
FROM log GROUP BY 1""")
def _(s):
    out = L.percentiles(run_log(s), "resource_name")
    return out.withColumns({p: F.round(p, 4) for p in ("p50", "p95", "p99")})


@query("log_exports", _LOG + f"""
SELECT user_name, query_type, query_text, start_time FROM log
WHERE {_MONTH} AND query_text ILIKE '%COPY INTO%@%' ORDER BY start_time DESC LIMIT 50""")
def _(s):
    return L.exports(run_log(s), NOW)


@query("log_failed", _LOG + """
SELECT query_id, error_code, error_message, query_text FROM log
WHERE start_time > TIMESTAMP '2024-01-29 12:00:00' AND error_code IS NOT NULL""")
def _(s):
    return L.failed(run_log(s), NOW, hours=24)


@query("log_top_consumers", _LOG + f"""
SELECT resource_name, ROUND(CAST(SUM(credits_used) AS DOUBLE), 2) AS credits FROM log WHERE {_WEEK} GROUP BY 1""")
def _(s):
    return L.top_consumers(run_log(s), NOW)


@query("cost_daily", _LOG + f"""
SELECT resource_name, CAST(start_time AS DATE) AS usage_date, CAST(SUM(credits_used) AS DOUBLE) AS total_credits,
  CAST(SUM(compute_credits) AS DOUBLE) AS compute_credits, CAST(SUM(cloud_credits) AS DOUBLE) AS cloud_service_credits,
  COUNT(*) AS query_count FROM log WHERE {_MONTH} GROUP BY ALL""")
def _(s):
    return L.cost_daily(run_log(s), NOW)


@query("cost_total", _LOG + f"""
SELECT resource_name, ROUND(CAST(SUM(credits_used) AS DOUBLE), 2) AS total_credits_30d,
  ROUND(CAST(SUM(credits_used) * 3 AS DOUBLE), 2) AS estimated_cost_30d,
  ROUND(AVG(credits_used), 4) AS avg_credits_per_hour, MIN(start_time) AS first_usage, MAX(end_time) AS last_usage
FROM log WHERE {_MONTH} GROUP BY 1""")
def _(s):
    return L.cost_total(run_log(s), NOW)


def _storage(s):
    per_day = run_log(s).groupBy(F.to_date("start_time").alias("usage_date")).agg(F.sum("bytes_scanned").alias("b"))
    return per_day.select("usage_date", F.col("b").alias("storage_bytes"), (F.col("b") * 2).alias("stage_bytes"),
                          (F.col("b") * 3).alias("failsafe_bytes"))


@query("cost_storage", _LOG + """
, d AS (SELECT CAST(start_time AS DATE) AS usage_date, CAST(SUM(bytes_scanned) AS BIGINT) AS b FROM log GROUP BY 1)
SELECT usage_date, ROUND(b / 1099511627776, 4) AS storage_tb, ROUND(2 * b / 1099511627776, 4) AS stage_tb,
  ROUND(3 * b / 1099511627776, 4) AS failsafe_tb, ROUND(6 * b / 1099511627776, 4) AS total_tb,
  ROUND(6 * b / 1099511627776 * 23, 2) AS estimated_cost FROM d WHERE usage_date > DATE '2023-12-31'""")
def _(s):
    return L.storage_daily(_storage(s), NOW)


@query("cost_storage_by_schema", _LOG + """
SELECT 'MAIN' AS database_name, resource_name AS schema_name, COUNT(*) AS table_count,
  ROUND(SUM(bytes_scanned) / 1073741824, 2) AS active_gb, ROUND(SUM(bytes_spilled_local) / 1073741824, 2)
    AS time_travel_gb, ROUND(SUM(bytes_spilled_remote) / 1073741824, 2) AS failsafe_gb,
  ROUND(SUM(bytes_scanned + bytes_spilled_local + bytes_spilled_remote) / 1073741824, 2) AS total_gb
FROM log WHERE error_code IS NULL GROUP BY ALL""")
def _(s):
    return L.storage_by_schema(run_log(s).select(
        F.lit("MAIN").alias("database_name"), F.col("resource_name").alias("schema_name"),
        F.col("bytes_scanned").alias("active_bytes"), F.col("bytes_spilled_local").alias("time_travel_bytes"),
        F.col("bytes_spilled_remote").alias("failsafe_bytes"), F.col("error_code").alias("deleted")))


@query("cost_services", _LOG + f"""
SELECT resource_name, CAST(start_time AS DATE) AS usage_date, CAST(SUM(credits_used) AS DOUBLE) AS credits_used,
  CAST(SUM(rows_produced) AS BIGINT) AS rows_produced, SUM(bytes_scanned) / 1073741824 AS gb_loaded
FROM log WHERE {_MONTH} GROUP BY ALL""")
def _(s):
    return L.service_usage(run_log(s), NOW, "bytes_scanned", "gb_loaded", counter="rows_produced")


def _usage_of(category, kind):
    return f"""SELECT CAST(start_time AS DATE) AS cost_date, '{category}' AS cost_category, resource_name,
  CAST(SUM(credits_used) AS DOUBLE) AS credits FROM log WHERE resource_name = '{kind}'
  AND start_time > TIMESTAMP '2023-11-01 12:00:00' GROUP BY ALL"""


@query("cost_union", _LOG + " UNION ALL ".join(_usage_of(c, k) for c, k in (
    ("COMPUTE", "view"), ("FILE_INGEST", "click"), ("AUTO_CLUSTERING", "signup"))))
def _(s):
    log = run_log(s)
    kinds = {"COMPUTE": "view", "FILE_INGEST": "click", "AUTO_CLUSTERING": "signup"}
    return L.cost_union({c: log.filter(F.col("resource_name") == k) for c, k in kinds.items()}, NOW)


@query("cost_idle", _LOG + f"""
SELECT resource_name, COUNT(*) AS hours_active, CAST(SUM(credits_used) AS DOUBLE) AS total_credits,
  COUNT(*) FILTER (queries_executed = 0) AS idle_hours,
  ROUND(CAST(SUM(credits_used) FILTER (queries_executed = 0) AS DOUBLE), 2) AS wasted_credits
FROM log WHERE {_WEEK} GROUP BY 1 HAVING SUM(credits_used) FILTER (queries_executed = 0) > 0""")
def _(s):
    return L.cost_idle(run_log(s), NOW)


@query("cost_downsize", _LOG + f"""
SELECT resource_name, resource_size, COUNT(*) AS query_count, AVG(execution_time) / 1000 AS avg_execution_sec,
  MAX(execution_time) / 1000 AS max_execution_sec, CAST(SUM(bytes_spilled_local) AS BIGINT) AS bytes_spilled_local,
  CAST(SUM(bytes_spilled_remote) AS BIGINT) AS bytes_spilled_remote FROM log WHERE {_WEEK} GROUP BY ALL""")
def _(s):
    return L.cost_downsize(run_log(s), NOW)


@query("cost_projection", _LOG + f"""
, d AS (SELECT CAST(start_time AS DATE) AS d, SUM(credits_used) AS c FROM log WHERE {_MONTH} GROUP BY 1)
SELECT ROUND(CAST(SUM(c) AS DOUBLE) / COUNT(*), 4) AS avg_daily_credits,
  ROUND(CAST(SUM(c) AS DOUBLE) / COUNT(*) * 30, 4) AS projected_monthly_credits,
  ROUND(CAST(SUM(c) AS DOUBLE) / COUNT(*) * 90, 4) AS projected_monthly_cost_usd FROM d""")
def _(s):
    return L.cost_projection(run_log(s), NOW)


@query("search_cost", _LOG + f"""
SELECT resource_name AS table_name, CAST(SUM(credits_used) AS DOUBLE) AS total_credits_7d,
  CAST(ROUND(SUM(credits_used) * CAST(4.29 AS DECIMAL(4,2)), 2) AS DOUBLE) AS estimated_monthly_credits
FROM log WHERE {_WEEK} GROUP BY 1""")
def _(s):
    return L.search_cost(run_log(s).withColumnRenamed("resource_name", "table_name"), NOW)


def _logins(s):
    return run_log(s).select(
        "user_name", F.concat(F.lit("10.0.0."), F.col("user_id") % 16).alias("client_ip"),
        F.when(F.col("state") == "FAILED", "NO").otherwise("YES").alias("is_success"), "error_code", "error_message",
        F.col("ts").alias("event_timestamp"))


@query("login_audit", _LOG + f"""
SELECT user_name, '10.0.0.' || user_id % 16 AS client_ip, 'NO' AS is_success, error_code, error_message,
  ts AS event_timestamp FROM log WHERE {_WEEK} AND state = 'FAILED' ORDER BY ts DESC LIMIT 50""")
def _(s):
    return L.failed_logins(_logins(s), NOW)


@query("login_by_address", _LOG + f"""
SELECT '10.0.0.' || user_id % 16 AS client_ip, COUNT(*) AS login_count, COUNT(DISTINCT user_name) AS unique_users,
  MIN(ts) AS first_login, MAX(ts) AS last_login FROM log WHERE {_MONTH} AND state = 'SUCCEEDED' GROUP BY 1""")
def _(s):
    return L.logins_by_address(_logins(s), NOW)


@query("task_health", _LOG + f"""
SELECT 'Tasks' AS component, COUNT(*) AS total, COUNT(*) FILTER (state = 'SUCCEEDED') AS healthy,
  COUNT(*) FILTER (state = 'FAILED') AS issues FROM log WHERE {_DAY}""")
def _(s):
    return L.task_health(run_log(s).withColumn("scheduled_time", F.col("ts")), NOW)


@query("perf_report", _LOG + """
SELECT query_text AS test_name, query_type AS test_category, resource_size AS warehouse_size,
  execution_time AS execution_time_ms, rows_produced AS rows_returned, ROUND(bytes_scanned / 1048576, 2) AS mb_scanned,
  partitions_scanned, partitions_total, 100 - k AS pruning_pct, ROUND(bytes_spilled_local / 1048576, 2)
    AS mb_spilled_local, ROUND(bytes_spilled_remote / 1048576, 2) AS mb_spilled_remote,
  CASE WHEN k > 96 THEN 'NEEDS_LARGER_WAREHOUSE' WHEN 100 - k < 50 THEN 'NEEDS_CLUSTERING'
    WHEN execution_time > 60000 THEN 'NEEDS_OPTIMIZATION' ELSE 'OK' END AS recommendation, ts AS test_timestamp
FROM log""")
def _(s):
    runs = run_log(s).select(
        F.col("query_text").alias("test_name"), F.col("query_type").alias("test_category"),
        F.col("resource_size").alias("warehouse_size"), F.col("execution_time").alias("execution_time_ms"),
        F.col("rows_produced").alias("rows_returned"), "bytes_scanned", "partitions_scanned", "partitions_total",
        (100 - F.col("k")).alias("pruning_pct"), "bytes_spilled_local", "bytes_spilled_remote",
        F.col("ts").alias("test_timestamp"))
    return L.perf_report(runs)


@query("size_benchmark", _LOG + f"""
SELECT resource_size AS warehouse_size, execution_time AS execution_ms,
  ROUND(execution_time * CASE resource_size WHEN 'X-Small' THEN 1 WHEN 'Small' THEN 2 WHEN 'Medium' THEN 4
    WHEN 'Large' THEN 8 WHEN 'X-Large' THEN 16 END / 3600000, 4) AS credits_used
FROM log WHERE {_WEEK} AND query_text LIKE '%FACT_SALES%' ORDER BY start_time DESC LIMIT 10""")
def _(s):
    return L.size_benchmark(run_log(s), NOW, "FACT_SALES")


@query("alert_conditions", _LOG + """
SELECT 'TASK_FAILURE' AS alert, COUNT(*) > 0 AS fired, CAST(COUNT(*) AS DOUBLE) AS value FROM log
  WHERE start_time > TIMESTAMP '2024-01-30 11:45:00' AND state = 'FAILED'
UNION ALL SELECT 'DATA_FRESHNESS', v > 6, v FROM
  (SELECT (epoch_us(TIMESTAMP '2024-01-30 12:00:00') - epoch_us(MAX(ts))) // 1000000 / 3600 AS v FROM log
    WHERE ts < TIMESTAMP '2024-01-30 00:00:00')
UNION ALL SELECT 'DQ_FAILURE', COUNT(*) > 0, COUNT(*) FROM log
  WHERE start_time >= TIMESTAMP '2024-01-29 12:00:00' AND k > 95
UNION ALL SELECT 'QUEUING', COALESCE(MAX(n) > 5, FALSE), MAX(n) FROM (SELECT COUNT(*) AS n FROM log
  WHERE start_time > TIMESTAMP '2024-01-30 11:30:00' AND queued_ms > 30000 GROUP BY resource_name)
UNION ALL SELECT 'HIGH_USAGE_TODAY', COALESCE(SUM(credits_used) > 50, FALSE), CAST(SUM(credits_used) AS DOUBLE) FROM log
  WHERE CAST(start_time AS DATE) = DATE '2024-01-30'
UNION ALL SELECT 'NO_FILES_LOADED', COUNT(*) = 0, COUNT(*) FROM log WHERE start_time > TIMESTAMP '2024-01-30 08:00:00'
  AND event_type_is_click
UNION ALL SELECT 'USAGE_THRESHOLD', COALESCE(SUM(credits_used) > 20, FALSE), CAST(SUM(credits_used) AS DOUBLE) FROM log
  WHERE start_time > TIMESTAMP '2024-01-29 12:00:00'""".replace("event_type_is_click", "resource_name = 'click'"))
def _(s):
    log = run_log(s)
    quality = log.select(F.col("ts").alias("validation_timestamp"),
                         F.when(F.col("k") > 95, "FAIL").otherwise("PASS").alias("status"))
    fact = log.filter(F.col("ts") < L.stamp(dt.datetime(2024, 1, 30))).select(F.col("ts").alias("load_timestamp"))
    loads = log.filter("resource_name = 'click'").select(F.col("ts").alias("last_load_time"))
    return L.alerts(log.withColumn("scheduled_time", F.col("ts")), fact, quality, log, log, loads, NOW)


# Lineage: region -> nation -> customer -> order, as an object graph

_EDGES = """WITH edges AS (
  SELECT 'R.' || n_regionkey AS s, 'N.' || n_nationkey AS t, 'NATION' AS kind FROM nation
  UNION ALL SELECT 'N.' || c_nationkey, 'C.' || c_custkey, 'CUSTOMER' FROM customer
  UNION ALL SELECT 'C.' || o_custkey, 'O.' || o_orderkey, 'ORDER' FROM orders
  UNION ALL SELECT 'O.' || l_orderkey, 'P.' || l_partkey, 'PART' FROM lineitem
)
"""


def _edges(s):
    def edge(table, a, ka, b, kb, source_type, target_type):
        return s.table(table).select(
            F.concat(F.lit(a), F.col(ka)).alias("source_object"), F.lit(source_type).alias("source_type"),
            F.concat(F.lit(b), F.col(kb)).alias("target_object"), F.lit(target_type).alias("target_type"))

    return (
        edge("nation", "R.", "n_regionkey", "N.", "n_nationkey", "REGION", "NATION")
        .unionByName(edge("customer", "N.", "c_nationkey", "C.", "c_custkey", "NATION", "CUSTOMER"))
        .unionByName(edge("orders", "C.", "o_custkey", "O.", "o_orderkey", "CUSTOMER", "ORDER"))
        .unionByName(edge("lineitem", "O.", "l_orderkey", "P.", "l_partkey", "ORDER", "PART"))
    )


@query("lineage_map", _EDGES + """
SELECT split_part(s, '.', 1) AS source_layer, split_part(t, '.', 1) AS target_layer, COUNT(*) AS edges
FROM edges GROUP BY ALL""")
def _(s):
    return G.lineage_map(_edges(s)).groupBy("source_layer", "target_layer").agg(F.count("*").alias("edges"))


@query("lineage_down", _EDGES + "SELECT DISTINCT t AS dependent_object, kind AS object_type FROM edges WHERE s = 'N.3'")
def _(s):
    return G.downstream(_edges(s), "N.3")


@query("lineage_up", _EDGES + """
SELECT DISTINCT s AS source_object, 'ORDER' AS source_type FROM edges WHERE t = 'P.7'""")
def _(s):
    return G.upstream(_edges(s), "P.7")


@query("impact_analysis", _EDGES + """
, l1 AS (SELECT DISTINCT t, kind FROM edges WHERE s = 'R.1'),
l2 AS (SELECT DISTINCT e.t, e.kind FROM edges e JOIN l1 ON e.s = l1.t),
l3 AS (SELECT DISTINCT e.t, e.kind FROM edges e JOIN l2 ON e.s = l2.t),
l4 AS (SELECT DISTINCT e.t, e.kind FROM edges e JOIN l3 ON e.s = l3.t)
SELECT 1 AS level, t AS object_path, kind AS object_type FROM l1 UNION ALL SELECT 2, * FROM l2
UNION ALL SELECT 3, * FROM l3 UNION ALL SELECT 4, * FROM l4""")
def _(s):
    return G.impact(_edges(s), "R.1", 5)


def _access_log(s):
    column = F.transform(F.sequence(F.lit(0), (F.col("k") % 3).cast("int")),
                         lambda i: F.struct(F.concat(F.lit("c"), i.cast("string")).alias("columnName")))
    objects = F.when(F.col("k") % 5 > 0, F.array(F.struct(
        F.upper("resource_name").alias("objectName"), F.lit("Table").alias("objectDomain"), column.alias("columns"))))
    return run_log(s).select(
        "query_id", "user_name", F.col("ts").alias("query_start_time"),
        F.coalesce(objects, F.array()).alias("base_objects_accessed"),
        F.array_repeat(F.lit("T"), (F.col("k") % 2).cast("int")).alias("objects_modified"))


@query("column_access", _LOG + f"""
SELECT query_id, user_name, upper(resource_name) AS object_accessed, 'Table' AS object_type, 'c' || i AS column_name
FROM log, LATERAL (SELECT UNNEST(range(0, k % 3 + 1)) AS i) WHERE {_WEEK} AND k % 5 > 0""")
def _(s):
    return G.column_access(_access_log(s), L.stamp(NOW - dt.timedelta(days=7)))


@query("recent_writes", _LOG + f"""
SELECT query_id, user_name, ts AS query_start_time FROM log WHERE {_DAY} AND k % 2 = 1 ORDER BY ts DESC LIMIT 50""")
def _(s):
    return G.recent_writes(_access_log(s), L.stamp(NOW - dt.timedelta(days=1))).select(
        "query_id", "user_name", "query_start_time")
