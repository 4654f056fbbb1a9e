"""Change capture, dimension and fact loads, versions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from martloom.catalog.oracle import star
from martloom.catalog.registry import query
from martloom.functions import dates as D
from martloom.operators import changes as C
from martloom.operators import dimensions as M
from martloom.operators import facts, keys
from martloom.operators import versions as V
from martloom.plans.star import customer_hash
from martloom.sources import sinks
from martloom.session import scratch_path

_KEY = ["customer_id"]
_DIFF = """, d AS (
  SELECT o.customer_id AS ok, n.customer_id AS nk, o.segment AS os, n.segment AS ns
  FROM customer_old o FULL JOIN customer_new n ON o.customer_id = n.customer_id
), diff AS (
  SELECT COALESCE(o.customer_id, n.customer_id) AS id, o.customer_id IS NOT NULL AND n.customer_id IS NOT NULL AS upd,
    o, n FROM customer_old o FULL JOIN customer_new n ON o.customer_id = n.customer_id
  WHERE o.customer_id IS NULL OR n.customer_id IS NULL OR o.segment <> n.segment
), changes AS (
  SELECT UNNEST(o), 'DELETE' AS action, upd AS is_update, md5(id) AS row_id FROM diff WHERE o.customer_id IS NOT NULL
  UNION ALL SELECT UNNEST(n), 'INSERT', upd, md5(id) FROM diff WHERE n.customer_id IS NOT NULL
)
"""


def _changes(s):
    return C.diff(s.customer_old, s.customer_new, _KEY)


@query("cdc_diff", star(_DIFF + "SELECT * REPLACE (CAST(balance AS DOUBLE) AS balance) FROM changes"))
def _(s):
    return _changes(s)


@query("cdc_diff_by_digest", star(_DIFF + """
SELECT * REPLACE (CAST(balance AS DOUBLE) AS balance) FROM changes"""))
def _(s):
    return C.diff_by_digest(s.customer_old, s.customer_new, _KEY)


@query("cdc_apply", star("SELECT * REPLACE (CAST(balance AS DOUBLE) AS balance) FROM customer_new"))
def _(s):
    return C.apply(s.customer_old, _changes(s), _KEY)


@query("cdc_summary", star(_DIFF + """
SELECT 'CUSTOMERS' AS stream_name, COUNT(*) AS total_changes,
  COUNT(*) FILTER (action = 'INSERT' AND NOT is_update) AS inserts, COUNT(*) FILTER (is_update) // 2 AS updates,
  COUNT(*) FILTER (action = 'DELETE' AND NOT is_update) AS deletes FROM changes"""))
def _(s):
    return C.summary(_changes(s), "CUSTOMERS")


@query("cdc_has_data", "SELECT 'CUSTOMERS' AS stream_name, TRUE AS has_data UNION ALL SELECT 'UNCHANGED', FALSE")
def _(s):
    return C.has_data({"CUSTOMERS": _changes(s), "UNCHANGED": C.diff(s.customer_old, s.customer_old, _KEY)})


@query("cdc_before_after", star("""
SELECT md5(o.customer_id) AS row_id, o.customer_id, o.segment AS segment_before, n.segment AS segment_after
FROM customer_old o JOIN customer_new n ON o.customer_id = n.customer_id WHERE o.segment <> n.segment"""))
def _(s):
    return C.before_after(_changes(s), _KEY).select(
        "row_id", "customer_id", F.col("before.segment").alias("segment_before"),
        F.col("after.segment").alias("segment_after"))


# Merges

_SETS = ["c_name", "c_nationkey", "balance", "segment"]


@query("merge_scd1", star("""
SELECT customer_id, c_custkey, c_name, c_nationkey, CAST(balance AS DOUBLE) AS balance, segment FROM customer_new
UNION ALL SELECT customer_id, c_custkey, c_name, c_nationkey, CAST(balance AS DOUBLE), segment FROM customer_old
WHERE c_custkey % 97 = 0"""))
def _(s):
    return M.overwrite_merge(s.customer_old, s.customer_new, _KEY, _SETS, order=[F.desc("c_custkey")])


@query("merge_scd1_if_changed", star("""
SELECT o.customer_id, CASE WHEN n.segment <> o.segment THEN 2 ELSE 1 END AS version,
  COALESCE(n.segment, o.segment) AS segment FROM customer_old o LEFT JOIN customer_new n USING (customer_id)
UNION ALL SELECT customer_id, 2, segment FROM customer_new
WHERE customer_id NOT IN (SELECT customer_id FROM customer_old)"""))
def _(s):
    target = s.customer_old.withColumn("version", F.lit(1)).withColumn("record_hash", customer_hash())
    source = s.customer_new.withColumn("version", F.lit(2)).withColumn("record_hash", customer_hash())
    merged = M.overwrite_merge(target, source, _KEY, [*_SETS, "version", "record_hash"],
                               changed=F.col("t_record_hash") != F.col("s_record_hash"))
    return merged.select("customer_id", "version", "segment")


def _slot(text: str, slices: int) -> str:
    return f"CAST(('0x' || left(md5({text}), 8)) AS BIGINT) % {slices}"


@query("load_dim_store", star(f"""
, old AS (SELECT s_suppkey + 1 AS store_key, 'STORE-' || s_suppkey AS store_id, s_name AS store_name, s_nationkey
  FROM supplier WHERE s_suppkey % 4 <> 0),
staged AS (SELECT 'STORE-' || s_suppkey AS store_id, s_name || ' new' AS store_name,
  (['NY', 'ME', 'CA', 'LA', 'NE', 'ZZ'])[1 + s_suppkey % 6] AS state, s_acctbal > 0 AS is_active
  FROM supplier WHERE s_suppkey % 3 <> 1),
fresh AS (SELECT *, (SELECT MAX(store_key) FROM old) + (ROW_NUMBER() OVER (PARTITION BY b ORDER BY store_id) - 1) * 64
    + b + 1 AS store_key
  FROM (SELECT *, {_slot('store_id', 64)} AS b FROM staged WHERE store_id NOT IN (SELECT store_id FROM old)))
SELECT COALESCE(old.store_key, fresh.store_key) AS store_key, COALESCE(old.store_id, s.store_id) AS store_id,
  COALESCE(s.store_name, old.store_name) AS store_name, s.state,
  CASE s.state WHEN 'NY' THEN 'Northeast' WHEN 'ME' THEN 'Northeast' WHEN 'CA' THEN 'West' WHEN 'LA' THEN 'South'
    WHEN 'NE' THEN 'Midwest' WHEN 'ZZ' THEN 'Other' END AS region, s.is_active
FROM old FULL JOIN staged s ON s.store_id = old.store_id LEFT JOIN fresh ON fresh.store_id = s.store_id"""))
def _(s):
    key = F.col("s_suppkey")
    suppliers = s.table("supplier")
    target = suppliers.filter(key % 4 != 0).select(
        (key + 1).alias("store_key"), F.concat(F.lit("STORE-"), key).alias("store_id"),
        F.col("s_name").alias("store_name"), F.lit(None).cast("string").alias("state"),
        F.lit(None).cast("string").alias("region"), F.lit(None).cast("boolean").alias("is_active"))
    states = F.array(*[F.lit(x) for x in ("NY", "ME", "CA", "LA", "NE", "ZZ")])
    staged = suppliers.filter(key % 3 != 1).select(
        F.concat(F.lit("STORE-"), key).alias("store_id"), F.concat("s_name", F.lit(" new")).alias("store_name"),
        F.get(states, (key % 6).cast("int")).alias("state"), (F.col("s_acctbal") > 0).alias("is_active"))
    return M.load_store(target, staged)


_PRODUCT_COST = "CAST(ROUND(CAST(p_retailprice AS DECIMAL(10,2)) * 0.70, 2) AS DECIMAL(10,2))"


@query("load_dim_product", star(f"""
, old AS (SELECT p_partkey + 1 AS product_key, 'PROD-' || p_partkey AS product_id, p_name AS product_name
  FROM part WHERE p_partkey % 5 <> 0),
fresh AS (SELECT product_id, (SELECT MAX(product_key) FROM old)
    + (ROW_NUMBER() OVER (PARTITION BY b ORDER BY product_id) - 1) * 64 + b + 1 AS product_key
  FROM (SELECT product_id, {_slot('product_id', 64)} AS b FROM dim_product WHERE product_key % 2 = 0
    AND product_id NOT IN (SELECT product_id FROM old)))
SELECT COALESCE(old.product_key, fresh.product_key) AS product_key, COALESCE(old.product_id, n.product_id) AS product_id,
  COALESCE(n.product_name || '!', old.product_name) AS product_name, CAST(n.unit_price AS DOUBLE) AS unit_price,
  CAST(n.unit_cost AS DOUBLE) AS unit_cost, CAST(n.profit_margin AS DOUBLE) AS profit_margin
FROM old FULL JOIN (SELECT * FROM dim_product WHERE product_key % 2 = 0) n ON n.product_id = old.product_id
  LEFT JOIN fresh ON fresh.product_id = n.product_id"""))
def _(s):
    key = F.col("p_partkey")
    money = "decimal(10,2)"
    target = s.table("part").filter(key % 5 != 0).select(
        (key + 1).alias("product_key"), F.concat(F.lit("PROD-"), key).alias("product_id"),
        F.col("p_name").alias("product_name"), F.lit(None).cast(money).alias("unit_price"),
        F.lit(None).cast(money).alias("unit_cost"), F.lit(None).cast("decimal(5,2)").alias("profit_margin"))
    changes = s.dim_product.filter("product_key % 2 = 0").select(
        "product_id", F.concat("product_name", F.lit("!")).alias("product_name"), "unit_price", "unit_cost")
    # The same change twice: one row per key is kept.
    return M.load_product(target, changes.unionByName(changes), [F.asc("product_name")])


def _dimension(s):
    """First load of the customer dimension, on 2001-01-01."""
    rows = s.customer_old.withColumn("record_hash", customer_hash()).select(
        F.col("c_custkey").alias("customer_key"), *s.customer_old.columns, "record_hash",
        D.day("2001-01-01").alias("effective_date"), F.lit(None).cast("date").alias("end_date"),
        F.lit(True).alias("is_current"))
    return rows


def _scd2(s):
    changes = s.customer_new.withColumn("record_hash", customer_hash())
    return M.scd2_load(_dimension(s), changes.unionByName(changes), "customer_id", "record_hash", s.as_of,
                       "customer_key", order=[F.asc("segment")])


_SCD2 = f""", opened AS (
  SELECT *, (SELECT MAX(c_custkey) FROM customer) + (ROW_NUMBER() OVER (PARTITION BY b ORDER BY customer_id) - 1) * 64
    + b + 1 AS customer_key
  FROM (SELECT n.*, {_slot('n.customer_id', 64)} AS b FROM customer_new n LEFT JOIN customer_old o USING (customer_id)
    WHERE o.customer_id IS NULL OR o.segment <> n.segment)
), scd2 AS (
  SELECT o.c_custkey AS customer_key, o.customer_id, o.segment, DATE '2001-01-01' AS effective_date,
    CASE WHEN n.segment <> o.segment THEN DATE '2001-07-30' END AS end_date,
    NOT COALESCE(n.segment <> o.segment, FALSE) AS is_current
  FROM customer_old o LEFT JOIN customer_new n USING (customer_id)
  UNION ALL SELECT customer_key, customer_id, segment, DATE '2001-07-31', NULL, TRUE FROM opened
)
"""
_SCD2_COLUMNS = ["customer_key", "customer_id", "segment", "effective_date", "end_date", "is_current"]


@query("scd2_load", star(_SCD2 + "SELECT * FROM scd2"))
def _(s):
    return _scd2(s).select(*_SCD2_COLUMNS)


@query("scd2_reload", star(_SCD2 + "SELECT * FROM scd2"))
def _(s):
    """Loading the same changes a second time, a day later, changes nothing."""
    changes = s.customer_new.withColumn("record_hash", customer_hash())
    again = M.scd2_load(_scd2(s), changes, "customer_id", "record_hash", s.as_of + dt.timedelta(days=1),
                        "customer_key")
    return again.select(*_SCD2_COLUMNS)


@query("test_scd2", """
SELECT 'ONE_CURRENT_PER_CUSTOMER' AS test_name, 'PASS' AS status,
  '0 customers with multiple current records' AS details
UNION ALL SELECT 'CURRENT_END_DATE_NULL', 'PASS', '0 current records with non-null end_date'""")
def _(s):
    from martloom.operators.quality import scd2_tests

    return scd2_tests(_scd2(s))


@query("test_scd2_gaps", "SELECT COUNT(*) AS gaps FROM customer WHERE FALSE")
def _(s):
    from martloom.operators.quality import scd2_gaps

    return scd2_gaps(_scd2(s)).agg(F.count("*").alias("gaps"))


@query("customer_history", star(_SCD2 + """
SELECT customer_key, customer_id, full_name, segment AS customer_segment, 'BRONZE' AS loyalty_tier, effective_date,
  end_date, is_current,
  CAST(date_diff('day', effective_date, COALESCE(end_date, DATE '2001-07-31')) AS INTEGER) AS days_in_version
FROM scd2 JOIN (SELECT c_name AS full_name, 'CUST-' || c_custkey AS customer_id FROM customer
  UNION ALL SELECT c_name, 'CUST-' || (c_custkey + 1000000000) FROM customer WHERE c_custkey % 40 = 0)
  USING (customer_id)"""))
def _(s):
    dimension = _scd2(s).withColumnsRenamed({"c_name": "full_name", "segment": "customer_segment"})
    return M.customer_history(dimension.withColumn("loyalty_tier", F.lit("BRONZE")), s.as_of)


_POINT_IN_TIME = star(_SCD2 + """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_day, c.customer_key, c.segment
FROM orders LEFT JOIN scd2 c ON c.customer_id = 'CUST-' || o_custkey
  AND CAST(o_orderdate AS DATE) BETWEEN effective_date AND COALESCE(end_date, DATE '9999-12-31')""")


def _dated_orders(s):
    return s.table("orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("order_day"),
        F.concat(F.lit("CUST-"), F.col("o_custkey")).alias("customer_id"))


@query("scd2_point_in_time", _POINT_IN_TIME)
def _(s):
    found = M.point_in_time(_dated_orders(s), _scd2(s), "customer_id", "order_day", ["customer_key", "segment"])
    return found.drop("customer_id")


@query("scd2_point_in_time_merged", _POINT_IN_TIME)
def _(s):
    found = M.point_in_time_merged(_dated_orders(s), _scd2(s), "customer_id", "order_day", ["customer_key", "segment"])
    return found.drop("customer_id")


@query("surrogate_keys", f"""
SELECT s_name, 1000 + (ROW_NUMBER() OVER (PARTITION BY b ORDER BY s_name) - 1) * 16 + b + 1 AS store_key
FROM (SELECT s_name, {_slot('s_name', 16)} AS b FROM supplier)""")
def _(s):
    return keys.add_keys(s.table("supplier").select("s_name"), "store_key", "s_name", 1000, 16)


# Facts

def _staged_orders(s):
    lines = s.fact_sales
    return lines.select(
        F.concat(F.lit("ORD-"), "order_id").alias("order_id"), "order_line_id",
        F.concat(F.lit("CUST-"), F.when(F.col("customer_key") % 11 == 0, "unknown").otherwise(
            F.col("customer_key").cast("string"))).alias("customer_id"),
        F.concat(F.lit("PROD-"), "product_key").alias("product_id"),
        F.concat(F.lit("STORE-"), "store_key").alias("store_id"),
        F.col("transaction_timestamp").alias("transaction_date"), "quantity", "unit_price", "discount_percent",
        F.col("net_amount").alias("total_amount"), "payment_method", "order_status",
        F.lit("given").alias("source_file"),
        (F.col("order_line_id") != 7).alias("dq_is_valid"))


def _short_calendar(s):
    return s.dim_date.filter(F.col("year_number") < 2001)


_LOADED = """, loaded AS (
  SELECT d.date_key, CASE WHEN customer_key % 11 <> 0 THEN customer_key END AS customer_key, product_key, store_key,
    'ORD-' || order_id AS order_id, order_line_id, quantity, unit_price, discount_percent,
    CAST(CAST(unit_price * quantity * discount_percent * 100 AS BIGINT) + 5000 AS BIGINT) // 10000 / 100.0
      AS discount_amount,
    unit_price * quantity AS gross_amount, net_amount, transaction_timestamp, payment_method, order_status
  FROM fact_sales f LEFT JOIN (SELECT * FROM dim_date WHERE year_number < 2001) d ON d.date_key = f.date_key
  WHERE order_line_id <> 7)
"""


@query("load_fact_sales", star(_LOADED + """
SELECT date_key, customer_key, product_key, store_key, order_id, order_line_id, quantity,
  CAST(unit_price AS DOUBLE) AS unit_price, CAST(discount_percent AS DOUBLE) AS discount_percent,
  CAST(gross_amount AS DOUBLE) AS gross_amount,
  CAST(net_amount AS DOUBLE) AS net_amount, transaction_timestamp, payment_method, order_status
FROM loaded WHERE date_key IS NOT NULL"""))
def _(s):
    fact, _rejected = facts.load_sales(_staged_orders(s), _short_calendar(s), s.dim_customer, s.dim_product,
                                       s.dim_store)
    return fact.drop("source_file", "discount_amount")


@query("load_fact_sales_rejects", star(_LOADED + """
SELECT order_id, order_line_id, product_key, 'date not in calendar' AS rejection_reason
FROM loaded WHERE date_key IS NULL"""))
def _(s):
    _fact, rejected = facts.load_sales(_staged_orders(s), _short_calendar(s), s.dim_customer, s.dim_product,
                                       s.dim_store)
    key = F.split_part(F.col("product_id"), F.lit("-"), F.lit(2)).cast("bigint")
    return rejected.select("order_id", "order_line_id", key.alias("product_key"), "rejection_reason")


def staged_clicks(events, s):
    """Events in the staging shape; every tenth is anonymous, every fiftieth invalid."""
    e, nothing = F.col("event_id"), F.lit(None)
    return events.select(
        e.alias("event_id"),
        F.concat(F.lit("S"), "user_id").alias("session_id"),
        F.when(e % 10 != 0, F.concat(F.lit("CUST-"), "user_id")).alias("customer_id"),
        F.col("ts").alias("event_timestamp"), F.upper("event_type").alias("event_type"),
        F.concat(F.lit("/p/"), "user_id").alias("page_url"), nothing.cast("string").alias("referrer_url"),
        F.lit("web").alias("device_type"), nothing.cast("string").alias("browser"),
        F.floor("value").cast("int").alias("duration_seconds"), nothing.cast("string").alias("product_id"),
        nothing.cast("string").alias("order_id"), F.col("value").cast("decimal(12,2)").alias("order_value"),
        F.lit("events").alias("source_file"), (e % 50 != 7).alias("dq_is_valid"))


def click_calendar(s):
    from martloom.operators.calendar import dim_date

    return dim_date(s.spark, dt.date(2024, 1, 1), 28)


CLICKS = """
SELECT event_id, CASE WHEN CAST(ts AS DATE) <= DATE '2024-01-28' THEN CAST(strftime(ts, '%Y%m%d') AS INTEGER) END
    AS date_key, c.c_custkey AS customer_key, 'S' || user_id AS session_id, ts AS event_timestamp,
  upper(event_type) AS event_type, '/p/' || user_id AS page_url, CAST(FLOOR(value) AS INTEGER) AS duration_seconds,
  CAST(CAST(value AS DECIMAL(12,2)) AS DOUBLE) AS order_value
FROM events LEFT JOIN customer c ON event_id % 10 <> 0 AND c_custkey = user_id WHERE event_id % 50 <> 7"""
CLICK_FACT = ["event_id", "date_key", "customer_key", "session_id", "event_timestamp", "event_type", "page_url",
              "duration_seconds", "order_value"]


@query("load_fact_clickstream", CLICKS)
def _(s):
    return facts.load_clickstream(staged_clicks(s.events, s), click_calendar(s), s.dim_customer).select(*CLICK_FACT)


@query("late_fact_upsert", star("""
, base AS (SELECT *, 0 AS late FROM fact_lines UNION ALL
  SELECT * REPLACE (quantity + 100 AS quantity), 1 FROM fact_lines WHERE order_id % 20 = 0)
SELECT order_id, order_line_id, quantity, CAST(net_amount AS DOUBLE) AS net_amount FROM base
QUALIFY ROW_NUMBER() OVER (PARTITION BY order_id, order_line_id ORDER BY late DESC, load_timestamp DESC, product_key,
  store_key, quantity, net_amount) = 1"""))
def _(s):
    order = [F.desc("load_timestamp"), F.asc("product_key"), F.asc("store_key"), F.asc("quantity"),
             F.asc("net_amount")]
    late = s.fact_lines.filter("order_id % 20 = 0").withColumn("quantity", F.col("quantity") + 100)
    return facts.upsert_late(s.fact_lines, late, order).select("order_id", "order_line_id", "quantity", "net_amount")


@query("inventory_latest", """
SELECT inventory_id, product_key, store_key, on_hand AS quantity_on_hand, on_hand - reserved <= 10 AS needs_reorder
FROM (SELECT l_orderkey * 10 + l_linenumber AS inventory_id, l_partkey AS product_key, l_suppkey AS store_key,
  CAST(l_quantity AS INTEGER) AS on_hand, l_linenumber * 2 AS reserved, l_shipdate AS t FROM lineitem)
QUALIFY ROW_NUMBER() OVER (PARTITION BY product_key, store_key ORDER BY t DESC, inventory_id DESC, on_hand) = 1""")
def _(s):
    stock = s.table("lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("inventory_id"),
        F.col("l_partkey").alias("product_key"), F.col("l_suppkey").alias("store_key"),
        F.col("l_quantity").cast("int").alias("quantity_on_hand"),
        (F.col("l_linenumber") * 2).alias("quantity_reserved"), F.lit(10).alias("reorder_point"),
        F.col("l_shipdate").alias("snapshot_timestamp"))
    return facts.inventory_latest(stock).select(
        "inventory_id", "product_key", "store_key", "quantity_on_hand", "needs_reorder")


# Versions

@query("version_counts", star("""
SELECT 'CURRENT' AS version, COUNT(*) AS cnt FROM customer_new
UNION ALL SELECT '1_HOUR_AGO', COUNT(*) FROM customer_old UNION ALL SELECT '1_DAY_AGO', COUNT(*) FROM customer_old"""))
def _(s):
    return V.counts({"CURRENT": s.customer_new, "1_HOUR_AGO": s.customer_old, "1_DAY_AGO": s.customer_old})


@query("version_deleted", star("""
SELECT customer_id, c_name FROM customer_old WHERE customer_id NOT IN (SELECT customer_id FROM customer_new)"""))
def _(s):
    return V.deleted(s.customer_old, s.customer_new, _KEY).select("customer_id", "c_name")


@query("version_added", star("""
SELECT customer_id, c_name FROM customer_new WHERE customer_id NOT IN (SELECT customer_id FROM customer_old)"""))
def _(s):
    return V.added(s.customer_old, s.customer_new, _KEY).select("customer_id", "c_name")


@query("restore_deleted", star("""
SELECT customer_id, segment FROM customer_new UNION ALL SELECT customer_id, segment FROM customer_old
WHERE customer_id NOT IN (SELECT customer_id FROM customer_new)"""))
def _(s):
    return V.restore_deleted(s.customer_old, s.customer_new, _KEY).select("customer_id", "segment")


_T0, _T1 = dt.datetime(2001, 7, 30, 12), dt.datetime(2001, 7, 31, 12)


@query("read_as_of", star("SELECT customer_id, segment FROM customer_old"))
def _(s):
    base = scratch_path(s.spark, "customer")
    sinks.write_version(s.customer_old, base, _T0)
    sinks.write_version(s.customer_new, base, _T1)
    return sinks.read_as_of(s.spark, base, seconds_ago=3600, now=_T1).select("customer_id", "segment")


@query("copy_table_as_of", star("SELECT customer_id, segment FROM customer_new"))
def _(s):
    base, target = scratch_path(s.spark, "customer"), scratch_path(s.spark, "customer-dev")
    sinks.write_version(s.customer_old, base, _T0)
    sinks.write_version(s.customer_new, base, _T1)
    sinks.copy_as_of(s.spark, base, target, _T1)
    return sinks.read_as_of(s.spark, target).select("customer_id", "segment")


@query("write_clustered", star("SELECT date_key, COUNT(*) AS lines FROM fact_sales GROUP BY 1"))
def _(s):
    path = scratch_path(s.spark, "fact-clustered")
    sinks.write_clustered(s.fact_sales, path, ["date_key", "store_key"], 8)
    return s.spark.read.parquet(path).groupBy("date_key").agg(F.count("*").alias("lines"))


@query("clustering_report")
def _(s):
    path = scratch_path(s.spark, "orders-clustered")
    sinks.write_clustered(s.order_heads, path, ["date_key"], 8)
    return sinks.clustering_report(s.spark, path, "date_key")
