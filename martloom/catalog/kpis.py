"""Key figures."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from martloom.catalog.oracle import mean, star
from martloom.catalog.registry import query
from martloom.functions import dates as D
from martloom.functions.measures import pct
from martloom.operators.keys import attach_scalars
from martloom.plans import kpis as K


def _two_months(s):
    return s.fact_between(D.month_before(s.as_of), D.month_after(s.as_of))


@query("kpi_executive_summary", star(f"""
, c AS (
  SELECT COUNT(DISTINCT order_id) AS o, COUNT(DISTINCT customer_key) AS k, SUM(net_amount) AS r,
    SUM(quantity) AS u, {mean('net_amount')} AS a, SUM(discount_amount) AS d, COUNT(DISTINCT full_date) AS n
  FROM fact_sales JOIN dim_date USING (date_key) WHERE is_current_month
), p AS (
  SELECT COUNT(DISTINCT order_id) AS o, COUNT(DISTINCT customer_key) AS k, SUM(net_amount) AS r
  FROM fact_sales JOIN dim_date USING (date_key) WHERE month_number = 6 AND year_number = 2001
)
SELECT c.o AS mtd_orders, c.k AS mtd_active_customers, CAST(c.r AS DOUBLE) AS mtd_revenue,
  CAST(c.u AS BIGINT) AS mtd_units_sold, c.a AS mtd_avg_order_value,
  ROUND(c.d / NULLIF(c.r + c.d, 0) * 100, 2) AS mtd_discount_rate,
  ROUND(c.r / NULLIF(c.n, 0), 2) AS avg_daily_revenue,
  ROUND((c.r - p.r) / NULLIF(p.r, 0) * 100, 2) AS revenue_mom_change_pct,
  ROUND((c.o - p.o) / NULLIF(p.o, 0) * 100, 2) AS orders_mom_change_pct,
  ROUND((c.k - p.k) / NULLIF(p.k, 0) * 100, 2) AS customers_mom_change_pct
FROM c, p"""))
def _(s):
    return K.executive_summary(_two_months(s), s.dim_date, s.as_of)


@query("kpi_customer_metrics", star(f"""
, t AS (
  SELECT c.customer_key, COUNT(DISTINCT order_id) AS o, SUM(net_amount) AS v,
    date_diff('day', MAX(full_date), DATE '2001-07-31') AS r
  FROM dim_customer c LEFT JOIN fact_sales f ON c.customer_key = f.customer_key
    LEFT JOIN dim_date d ON f.date_key = d.date_key
  GROUP BY 1
), m AS (SELECT list_sort(list(CAST(v * 100 AS HUGEINT)) FILTER (v IS NOT NULL)) AS cents FROM t)
SELECT COUNT(*) AS total_customers, COUNT(*) FILTER (o > 0) AS customers_with_purchases,
  ROUND(COUNT(*) FILTER (o > 0) / COUNT(*) * 100, 2) AS conversion_rate_pct,
  COUNT(*) FILTER (r <= 30) AS active_last_30d, COUNT(*) FILTER (r <= 90) AS active_last_90d,
  COUNT(*) FILTER (r > 180) AS churned_customers,
  ROUND(COUNT(*) FILTER (r <= 90) / NULLIF(COUNT(*) FILTER (o > 0), 0) * 100, 2) AS retention_rate_90d_pct,
  {mean('v')} AS avg_customer_ltv, (SELECT CAST((cents[(len(cents) + 1) // 2] + cents[len(cents) // 2 + 1] + 1) // 2 AS DOUBLE) / 100 FROM m)
    AS median_customer_ltv,
  ROUND(AVG(o) FILTER (o > 0), 2) AS avg_orders_per_customer,
  ROUND(COUNT(*) FILTER (o > 1) / NULLIF(COUNT(*) FILTER (o > 0), 0) * 100, 2) AS repeat_purchase_rate_pct
FROM t"""))
def _(s):
    return K.customer_metrics(s.dim_customer, s.fact_sales, s.dim_date, s.as_of)


@query("kpi_product_metrics", star("""
SELECT category, COUNT(DISTINCT p.product_key) AS total_products,
  COUNT(DISTINCT CASE WHEN is_active THEN p.product_key END) AS active_products,
  COUNT(DISTINCT order_id) AS total_orders, CAST(SUM(quantity) AS BIGINT) AS total_units_sold,
  CAST(SUM(net_amount) AS DOUBLE) AS total_revenue,
  ROUND(SUM(net_amount) / NULLIF(COUNT(DISTINCT p.product_key), 0), 2) AS revenue_per_product,
  ROUND(AVG(profit_margin), 2) AS avg_profit_margin,
  ROUND(COUNT(DISTINCT order_id) / NULLIF(COUNT(DISTINCT CASE WHEN is_active THEN p.product_key END), 0), 2)
    AS orders_per_active_product
FROM dim_product p LEFT JOIN fact_lines f ON p.product_key = f.product_key GROUP BY 1"""))
def _(s):
    return K.product_metrics(s.dim_product, s.fact_lines)


@query("kpi_regional_performance", star(f"""
SELECT region, COUNT(DISTINCT s.store_key) AS store_count, COUNT(DISTINCT order_id) AS total_orders,
  COUNT(DISTINCT customer_key) AS unique_customers, CAST(SUM(net_amount) AS DOUBLE) AS total_revenue,
  ROUND(SUM(net_amount) / NULLIF(COUNT(DISTINCT s.store_key), 0), 2) AS revenue_per_store,
  ROUND(SUM(net_amount) / NULLIF(COUNT(DISTINCT customer_key), 0), 2) AS revenue_per_customer,
  {mean('net_amount')} AS avg_order_value, {mean('discount_percent')} AS avg_discount_pct,
  ROUND(SUM(net_amount) / (SELECT SUM(net_amount) FROM fact_lines) * 100, 2) AS revenue_share_pct
FROM dim_store s LEFT JOIN fact_sales f ON s.store_key = f.store_key WHERE is_active GROUP BY 1"""))
def _(s):
    return K.regional_performance(s.dim_store, s.fact_sales)


def _snapshot_oracle(day: str, start: str) -> str:
    return f"""
  SELECT DATE '{day}' AS snapshot_date, 'TOTAL_REVENUE_MTD' AS kpi_name, 'Revenue' AS kpi_category,
    CAST(SUM(net_amount) AS DOUBLE) AS kpi_value, 'USD' AS kpi_unit
  FROM sold WHERE month_start_date = DATE '{start}'
  UNION ALL SELECT DATE '{day}', 'ACTIVE_CUSTOMERS_30D', 'Customer', COUNT(DISTINCT customer_key), 'Count'
  FROM sold WHERE full_date >= DATE '{day}' - 30
  UNION ALL SELECT DATE '{day}', 'AVG_ORDER_VALUE_MTD', 'Sales', {mean('net_amount')}, 'USD'
  FROM sold WHERE month_start_date = DATE '{start}'"""


@query("kpi_snapshot", star(f"""
, sold AS (SELECT * FROM fact_sales JOIN dim_date USING (date_key)), shots AS (
{_snapshot_oracle('2001-07-30', '2001-07-01')} UNION ALL {_snapshot_oracle('2001-07-31', '2001-07-01')})
SELECT n.*, b.kpi_value AS previous_value,
  ROUND((n.kpi_value - b.kpi_value) / NULLIF(b.kpi_value, 0) * 100, 2) AS change_pct
FROM shots n LEFT JOIN shots b ON b.kpi_name = n.kpi_name AND b.snapshot_date = DATE '2001-07-30'
WHERE n.snapshot_date = DATE '2001-07-31'"""))
def _(s):
    fact = s.fact_between(dt.date(2001, 6, 30), dt.date(2002, 1, 1))
    both = K.snapshot_for(fact, s.dim_date, dt.date(2001, 7, 30)).unionByName(
        K.snapshot_for(fact, s.dim_date, s.as_of))
    return K.with_previous_day(both, s.as_of)


def _monthly_orders(s):
    month = F.trunc(F.to_date("o_orderdate"), "month")
    return s.table("orders").groupBy(month.alias("month")).agg(F.count("*").alias("orders"))


@query("cross_join_scalar", """
WITH t AS (SELECT MIN(o_orderdate) AS first_order, MAX(o_orderdate) AS last_order FROM orders),
  c AS (SELECT COUNT(*) AS customers FROM customer)
SELECT first_order, last_order, customers FROM t, c""")
def _(s):
    span = s.table("orders").agg(F.min("o_orderdate").alias("first_order"), F.max("o_orderdate").alias("last_order"))
    return attach_scalars(span, s.table("customer").agg(F.count("*").alias("customers")))


@query("scalar_subquery_share", star("""
SELECT store_key, CAST(SUM(net_amount) AS DOUBLE) AS revenue,
  ROUND(SUM(net_amount) / (SELECT SUM(net_amount) FROM fact_lines) * 100, 2) AS share_pct
FROM fact_lines GROUP BY 1"""))
def _(s):
    per_store = s.fact_lines.groupBy("store_key").agg(F.sum("net_amount").alias("revenue"))
    shared = attach_scalars(per_store, s.fact_lines.agg(F.sum("net_amount").alias("total")))
    return shared.select("store_key", "revenue", pct(F.col("revenue"), F.col("total")).alias("share_pct"))


@query("self_join_prev_day", """
WITH d AS (SELECT CAST(ts AS DATE) AS snapshot_date, event_type AS kpi_name, COUNT(*) AS kpi_value
  FROM events GROUP BY ALL)
SELECT n.*, b.kpi_value AS previous_value,
  ROUND((n.kpi_value - b.kpi_value) / NULLIF(b.kpi_value, 0) * 100, 2) AS change_pct
FROM d n LEFT JOIN d b ON n.kpi_name = b.kpi_name AND b.snapshot_date = n.snapshot_date - 1""")
def _(s):
    from martloom.functions.measures import change_pct
    from martloom.operators.periods import with_same_period

    daily = s.events.groupBy(F.to_date("ts").alias("snapshot_date"), F.col("event_type").alias("kpi_name")).agg(
        F.count("*").alias("kpi_value"))
    joined = with_same_period(daily, ["kpi_name"], "snapshot_date", F.date_sub("snapshot_date", 1), "kpi_value",
                              "previous_value")
    return joined.withColumn("change_pct", change_pct(F.col("kpi_value"), F.col("previous_value")))
