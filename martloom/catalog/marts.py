"""Sales and customer marts over the star."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from martloom.catalog.oracle import mean, star
from martloom.catalog.registry import query
from martloom.functions import dates as D
from martloom.operators import calendar as C
from martloom.plans import marts as M


def rounded(df, *columns, scale=2):
    return df.withColumns({c: F.round(F.col(c), scale) for c in columns})


_LINE_SUMS = f"""
  CAST(SUM(quantity) AS BIGINT) AS units_sold,
  CAST(SUM(gross_amount) AS DOUBLE) AS gross_revenue,
  CAST(SUM(discount_amount) AS DOUBLE) AS total_discounts,
  CAST(SUM(net_amount) AS DOUBLE) AS net_revenue,
  {mean('net_amount')} AS avg_order_value"""


@query("mv_daily_sales_summary", star(f"""
SELECT full_date AS sales_date, day_name, week_of_year, month_number, month_name, year_number, is_weekend,
  region, store_type, category AS product_category,
  COUNT(DISTINCT order_id) AS order_count, COUNT(DISTINCT customer_key) AS unique_customers,{_LINE_SUMS},
  {mean('discount_percent')} AS avg_discount_pct
FROM fact_sales JOIN dim_date USING (date_key) JOIN dim_store USING (store_key) JOIN dim_product USING (product_key)
GROUP BY ALL"""))
def _(s):
    return rounded(M.daily_sales_summary(s.fact_sales, s.dim_date, s.dim_store, s.dim_product),
                   "avg_order_value", "avg_discount_pct")


@query("agg_daily_sales_simple", star(f"""
SELECT full_date AS sales_date, day_name, month_name, year_number, region, store_name, category AS product_category,
  COUNT(DISTINCT order_id) AS order_count,{_LINE_SUMS}
FROM fact_sales JOIN dim_date USING (date_key) JOIN dim_store USING (store_key) JOIN dim_product USING (product_key)
GROUP BY ALL"""))
def _(s):
    return rounded(M.daily_sales_by_store(s.fact_sales, s.dim_date, s.dim_store, s.dim_product), "avg_order_value")


@query("agg_daily_sales", star(f"""
, daily AS (
  SELECT full_date AS sale_date, region, store_type, category AS product_category, customer_segment,
    COUNT(DISTINCT order_id) AS order_count, COUNT(DISTINCT f.customer_key) AS unique_customers,
    CAST(SUM(quantity) AS BIGINT) AS units_sold, SUM(gross_amount) AS gross_revenue,
    SUM(discount_amount) AS total_discounts, SUM(net_amount) AS net_revenue,
    {mean('net_amount')} AS avg_order_value, {mean('discount_percent')} AS avg_discount_pct
  FROM fact_sales f JOIN dim_date USING (date_key) JOIN dim_store USING (store_key)
    JOIN dim_product USING (product_key)
    LEFT JOIN (SELECT customer_key, customer_segment FROM dim_customer WHERE is_current) c
      ON c.customer_key = f.customer_key
  GROUP BY ALL
), earlier AS (
  SELECT *, LAG(net_revenue) OVER w AS p1, LAG(net_revenue, 7) OVER w AS p7 FROM daily
  WINDOW w AS (PARTITION BY region, store_type, product_category, customer_segment ORDER BY sale_date)
)
SELECT sale_date, region, store_type, product_category, customer_segment, order_count, unique_customers, units_sold,
  CAST(gross_revenue AS DOUBLE) AS gross_revenue, CAST(total_discounts AS DOUBLE) AS total_discounts,
  CAST(net_revenue AS DOUBLE) AS net_revenue, avg_order_value, avg_discount_pct,
  CAST(p1 AS DOUBLE) AS prev_day_revenue, ROUND((net_revenue - p1) / NULLIF(p1, 0) * 100, 2) AS dod_revenue_change_pct,
  CAST(p7 AS DOUBLE) AS same_day_last_week_revenue,
  ROUND((net_revenue - p7) / NULLIF(p7, 0) * 100, 2) AS wow_revenue_change_pct
FROM earlier"""))
def _(s):
    return M.daily_sales(s.fact_sales, s.dim_date, s.dim_store, s.dim_product, s.dim_customer)


@query("agg_monthly_sales", star(f"""
, monthly AS (
  SELECT year_number, month_number, month_name, region, category AS product_category,
    COUNT(DISTINCT order_id) AS order_count, COUNT(DISTINCT customer_key) AS unique_customers,
    CAST(SUM(quantity) AS BIGINT) AS units_sold, SUM(net_amount) AS net_revenue,
    {mean('net_amount')} AS avg_order_value
  FROM fact_sales JOIN dim_date USING (date_key) JOIN dim_store USING (store_key) JOIN dim_product USING (product_key)
  GROUP BY ALL
), earlier AS (
  SELECT *, LAG(net_revenue) OVER w AS p1, LAG(net_revenue, 12) OVER w AS p12,
    SUM(net_revenue) OVER (PARTITION BY year_number, region, product_category ORDER BY month_number) AS ytd
  FROM monthly WINDOW w AS (PARTITION BY region, product_category ORDER BY year_number, month_number)
)
SELECT year_number, month_number, month_name, region, product_category, order_count, unique_customers, units_sold,
  CAST(net_revenue AS DOUBLE) AS net_revenue, avg_order_value,
  CAST(p1 AS DOUBLE) AS prev_month_revenue, ROUND((net_revenue - p1) / NULLIF(p1, 0) * 100, 2) AS mom_change_pct,
  CAST(p12 AS DOUBLE) AS same_month_last_year_revenue,
  ROUND((net_revenue - p12) / NULLIF(p12, 0) * 100, 2) AS yoy_change_pct,
  CAST(ytd AS DOUBLE) AS ytd_revenue
FROM earlier"""))
def _(s):
    return M.monthly_sales(s.fact_sales, s.dim_date, s.dim_store, s.dim_product)


C360_ORACLE = """, c360 AS (
  SELECT c.customer_key, customer_id, full_name, email, customer_segment, loyalty_tier, city, state, region,
    registration_date, COUNT(DISTINCT order_id) AS total_orders,
    CAST(SUM(quantity) AS BIGINT) AS total_items_purchased,
    SUM(net_amount) AS lifetime_value, AVG(net_amount) AS avg_order_value,
    MIN(full_date) AS first_purchase_date, MAX(full_date) AS last_purchase_date,
    CAST(date_diff('day', MAX(full_date), DATE '2001-07-31') AS INTEGER) AS days_since_last_purchase,
    CAST(date_diff('day', registration_date, DATE '2001-07-31') AS INTEGER) AS customer_tenure_days
  FROM dim_customer c LEFT JOIN fact_sales f ON c.customer_key = f.customer_key
    LEFT JOIN dim_date d ON d.date_key = f.date_key
  WHERE c.is_current GROUP BY ALL
)"""


@query("mv_customer_360", star(f"""{C360_ORACLE}
SELECT * REPLACE (CAST(lifetime_value AS DOUBLE) AS lifetime_value, ROUND(avg_order_value, 2) AS avg_order_value)
FROM c360"""))
def _(s):
    return rounded(M.customer_360(s.dim_customer, s.fact_sales, s.dim_date, s.as_of), "avg_order_value")


@query("agg_customer_360", star(f"""{C360_ORACLE}
SELECT customer_key, customer_id, full_name, customer_segment, loyalty_tier, city, state, region, total_orders,
  total_items_purchased AS total_items, CAST(lifetime_value AS DOUBLE) AS lifetime_value,
  ROUND(avg_order_value, 2) AS avg_order_value, first_purchase_date, last_purchase_date, days_since_last_purchase
FROM c360"""))
def _(s):
    return rounded(M.customer_360_short(s.dim_customer, s.fact_sales, s.dim_date, s.as_of), "avg_order_value")


@query("agg_customer_segments", star(f"""{C360_ORACLE}
SELECT customer_segment, loyalty_tier, region, COUNT(*) AS customer_count,
  COUNT(*) FILTER (days_since_last_purchase <= 90) AS active_customer_count,
  CAST(SUM(total_orders) AS BIGINT) AS total_orders, CAST(SUM(lifetime_value) AS DOUBLE) AS total_revenue,
  {mean('lifetime_value')} AS avg_lifetime_value,
  {mean('lifetime_value', 2, 'SUM(total_orders)')} AS avg_order_value,
  {mean('total_orders', 2, 'COUNT(*)')} AS avg_orders_per_customer,
  ROUND(AVG(days_since_last_purchase), 1) AS avg_days_since_last_purchase
FROM c360 GROUP BY ALL"""))
def _(s):
    return M.customer_segments(M.customer_360(s.dim_customer, s.fact_sales, s.dim_date, s.as_of))


@query("mv_product_performance", star("""
SELECT p.product_key, product_id, product_name, category, subcategory, brand,
  CAST(p.unit_price AS DOUBLE) AS unit_price, CAST(unit_cost AS DOUBLE) AS unit_cost,
  CAST(profit_margin AS DOUBLE) AS profit_margin,
  COUNT(DISTINCT order_id) AS times_ordered, COUNT(DISTINCT customer_key) AS unique_buyers,
  CAST(SUM(quantity) AS BIGINT) AS units_sold, CAST(SUM(net_amount) AS DOUBLE) AS total_revenue,
  CAST(SUM(quantity * unit_cost) AS DOUBLE) AS total_cost,
  CAST(SUM(net_amount) - SUM(quantity * unit_cost) AS DOUBLE) AS total_profit,
  ROUND(AVG(quantity), 2) AS avg_quantity_per_order
FROM dim_product p LEFT JOIN fact_sales f ON p.product_key = f.product_key GROUP BY ALL"""))
def _(s):
    return rounded(M.product_performance(s.dim_product, s.fact_sales), "avg_quantity_per_order")


@query("region_daily_report", star(f"""
SELECT full_date, day_name, region, COUNT(DISTINCT order_id) AS order_count,
  CAST(SUM(quantity) AS BIGINT) AS units_sold, CAST(SUM(net_amount) AS DOUBLE) AS total_revenue,
  {mean('net_amount')} AS avg_order_value
FROM fact_sales JOIN dim_date USING (date_key) JOIN dim_store USING (store_key)
GROUP BY ALL ORDER BY full_date, region LIMIT 20"""))
def _(s):
    return M.region_daily_report(s.fact_sales, s.dim_date, s.dim_store)


@query("product_report", star("""
SELECT category, subcategory, brand, COUNT(DISTINCT order_id) AS order_count,
  CAST(SUM(quantity) AS BIGINT) AS units_sold, CAST(SUM(net_amount) AS DOUBLE) AS revenue,
  CAST(SUM(gross_amount - net_amount) AS DOUBLE) AS total_discount_given
FROM fact_lines JOIN dim_product USING (product_key)
GROUP BY ALL ORDER BY revenue DESC, category, subcategory, brand LIMIT 20"""))
def _(s):
    return M.product_report(s.fact_lines, s.dim_product)


@query("customer_pattern_report", star(f"""
SELECT customer_segment, loyalty_tier, COUNT(DISTINCT customer_key) AS customer_count,
  COUNT(DISTINCT order_id) AS total_orders, CAST(SUM(net_amount) AS DOUBLE) AS total_revenue,
  {mean('net_amount', 2, 'COUNT(DISTINCT customer_key)')} AS revenue_per_customer,
  CAST((COUNT(DISTINCT order_id) * 200 + COUNT(DISTINCT customer_key)) // (2 * COUNT(DISTINCT customer_key)) AS DOUBLE)
    / 100 AS orders_per_customer
FROM fact_sales JOIN dim_customer USING (customer_key) WHERE is_current GROUP BY ALL"""))
def _(s):
    return M.customer_pattern_report(s.fact_sales, s.dim_customer)


@query("fact_quality_summary", star("""
SELECT COUNT(*) AS total_rows, COUNT(DISTINCT order_id) AS unique_orders,
  COUNT(DISTINCT customer_key) AS unique_customers, COUNT(DISTINCT product_key) AS unique_products,
  COUNT(DISTINCT store_key) AS unique_stores, MIN(transaction_timestamp) AS earliest_transaction,
  MAX(transaction_timestamp) AS latest_transaction, CAST(SUM(net_amount) AS DOUBLE) AS total_revenue,
  ROUND(AVG(net_amount), 2) AS avg_order_value
FROM fact_sales"""))
def _(s):
    return rounded(M.fact_quality_summary(s.fact_sales), "avg_order_value")


@query("category_summary", star("""
SELECT category, subcategory, COUNT(*) AS product_count, ROUND(AVG(unit_price), 2) AS avg_price,
  ROUND(AVG(profit_margin), 2) AS avg_margin, COUNT(*) FILTER (is_active) AS active_count
FROM dim_product GROUP BY ALL"""))
def _(s):
    return rounded(M.category_summary(s.dim_product), "avg_price", "avg_margin")


@query("store_regional_summary", star("""
SELECT region, store_type, COUNT(*) AS store_count, CAST(SUM(square_footage) AS BIGINT) AS total_sqft,
  ROUND(AVG(square_footage), 2) AS avg_sqft, MIN(open_date) AS earliest_open, MAX(open_date) AS latest_open
FROM dim_store WHERE is_active GROUP BY ALL"""))
def _(s):
    return rounded(M.store_regional_summary(s.dim_store), "avg_sqft")


def _with_orders(s, days):
    """Every day of a calendar with its number of orders."""
    per_day = s.order_heads.groupBy("date_key").agg(F.count("*").alias("orders"))
    return days.join(per_day, "date_key", "left").fillna(0, ["orders"])


_DAYS = """, days AS (
  SELECT dim_date.*, COALESCE(orders, 0) AS orders FROM dim_date LEFT JOIN (
    SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key, COUNT(*) AS orders FROM orders GROUP BY 1)
  USING (date_key))
"""


@query("business_days_by_month", star(f"""{_DAYS}
SELECT year_number, month_number, month_name, COUNT(*) AS total_days,
  COUNT(*) FILTER (is_business_day) AS business_days, COUNT(*) FILTER (is_weekend) AS weekend_days,
  COUNT(*) FILTER (is_holiday) AS holidays, CAST(SUM(orders) AS BIGINT) AS orders
FROM days GROUP BY ALL"""))
def _(s):
    per_month = _with_orders(s, s.dim_date).groupBy("year_number", "month_number").agg(F.sum("orders").alias("orders"))
    return C.business_days_by_month(s.dim_date).join(per_month, ["year_number", "month_number"])


@query("date_dim_coverage", star(f"""{_DAYS}
SELECT MIN(full_date) AS earliest_date, MAX(full_date) AS latest_date, COUNT(*) AS total_days,
  COUNT(DISTINCT year_number) AS years_covered, COUNT(*) FILTER (is_holiday) AS total_holidays,
  COUNT(*) FILTER (orders > 0) AS days_with_orders FROM days"""))
def _(s):
    sold = s.order_heads.agg(F.countDistinct("date_key").alias("n"))
    return C.date_coverage(s.dim_date).withColumn("days_with_orders", sold.scalar())


@query("current_month_calendar", star(f"""{_DAYS}
SELECT date_key, full_date, day_name, is_weekend, is_holiday, is_business_day, orders FROM days WHERE is_current_month"""))
def _(s):
    return _with_orders(s, C.current_month_calendar(s.dim_date))


@query("dim_date", star(f"{_DAYS} SELECT * FROM days"))
def _(s):
    return _with_orders(s, s.dim_date)


@query("dim_date_holidays", star("""
SELECT full_date, holiday_name, COUNT(o_orderkey) AS orders
FROM dim_date JOIN orders ON CAST(o_orderdate AS DATE) = full_date WHERE is_holiday GROUP BY ALL"""))
def _(s):
    per_day = s.order_heads.groupBy("date_key").agg(F.count("*").alias("orders"))
    return s.dim_date.filter("is_holiday").join(per_day, "date_key").select("full_date", "holiday_name", "orders")


@query("generate_dates", star("""
SELECT d AS date_value, COUNT(o_orderkey) AS orders
FROM (SELECT CAST(DATE '1995-01-01' + CAST(i AS INTEGER) AS DATE) AS d FROM range(2557) t(i))
  LEFT JOIN orders ON CAST(o_orderdate AS DATE) = d GROUP BY ALL"""))
def _(s):
    per_day = s.table("orders").groupBy(F.to_date("o_orderdate").alias("date_value")).agg(
        F.count("*").alias("orders"))
    days = C.generate_dates(s.spark, dt.date(1995, 1, 1), 2557)
    return days.join(per_day, "date_value", "left").fillna(0, ["orders"])


@query("region_category_revenue", star("""
SELECT region, category, COUNT(DISTINCT order_id) AS orders, CAST(SUM(net_amount) AS DOUBLE) AS revenue
FROM fact_sales JOIN dim_date USING (date_key) JOIN dim_store USING (store_key) JOIN dim_product USING (product_key)
WHERE year_number = 2000 GROUP BY ALL"""))
def _(s):
    year = s.fact_between(dt.date(2000, 1, 1), dt.date(2001, 1, 1))
    return M.region_category_revenue(year, s.dim_date, s.dim_store, s.dim_product, 2000)


@query("sales_report", star("""
SELECT '{"report_type":"SALES","start_date":"2000-01-01","end_date":"2000-12-31",' ||
  '"generated_at":"2001-07-31T00:00:00","metrics":{"total_orders":' || COUNT(DISTINCT order_id) ||
  ',"total_revenue":' || CAST(SUM(net_amount) AS VARCHAR) || '}}' AS report
FROM fact_sales JOIN dim_date USING (date_key)
WHERE full_date BETWEEN DATE '2000-01-01' AND DATE '2000-12-31'"""))
def _(s):
    first, last = dt.date(2000, 1, 1), dt.date(2000, 12, 31)
    fact = s.fact_between(first, last + dt.timedelta(days=1))
    return M.sales_report(fact, s.dim_date, first, last, "SALES", dt.datetime(2001, 7, 31))


@query("conditional_rates", star("""
SELECT region, COUNT(*) AS total_orders, COUNT(*) FILTER (order_status = 'F') AS completed,
  COUNT(*) FILTER (order_status = 'O') AS cancelled,
  ROUND(COUNT(*) FILTER (order_status = 'F') / COUNT(*) * 100, 2) AS completion_rate
FROM fact_sales JOIN dim_store USING (store_key) GROUP BY ALL"""))
def _(s):
    return M.status_rates(s.fact_sales, s.dim_store, "F", "O")


@query("shared_sales_summary", star(f"""
SELECT full_date AS sale_date, month_name, year_number, region, category AS product_category, brand,
  COUNT(DISTINCT order_id) AS order_count, CAST(SUM(quantity) AS BIGINT) AS units_sold,
  CAST(SUM(net_amount) AS DOUBLE) AS net_revenue, {mean('net_amount')} AS avg_order_value
FROM fact_sales JOIN dim_date USING (date_key) JOIN dim_store USING (store_key) JOIN dim_product USING (product_key)
GROUP BY ALL"""))
def _(s):
    return M.shared_sales_summary(s.fact_sales, s.dim_date, s.dim_store, s.dim_product)


@query("monthly_revenue_by_store", star("""
SELECT year_number AS year, month_number AS month, store_name AS store, CAST(SUM(net_amount) AS DOUBLE) AS revenue
FROM fact_sales JOIN dim_date USING (date_key) JOIN dim_store USING (store_key) GROUP BY ALL"""))
def _(s):
    return M.monthly_revenue_by_store(s.fact_sales, s.dim_date, s.dim_store)


@query("customer_cohorts", star("""
, firsts AS (SELECT customer_key, MIN(full_date) AS f FROM fact_sales JOIN dim_date USING (date_key) GROUP BY 1)
SELECT make_date(year(f), month(f), 1) AS cohort_month,
  CAST(date_diff('month', f, full_date) AS INTEGER) AS months_since,
  COUNT(DISTINCT customer_key) AS customers, CAST(SUM(net_amount) AS DOUBLE) AS revenue
FROM fact_sales JOIN dim_date USING (date_key) JOIN firsts USING (customer_key) GROUP BY ALL"""))
def _(s):
    return M.customer_cohorts(s.fact_sales, s.dim_date)


@query("conversion_funnel", """
WITH k AS (
  SELECT user_id || '-' || CAST(ts AS DATE) AS k, bool_or(event_type = 'view') a, bool_or(event_type = 'click') b,
    bool_or(event_type = 'signup') c, bool_or(event_type = 'purchase') d
  FROM events GROUP BY 1
), n AS (
  SELECT COUNT(*) FILTER (a) AS n1, COUNT(*) FILTER (a AND b) AS n2, COUNT(*) FILTER (a AND b AND c) AS n3,
    COUNT(*) FILTER (a AND b AND c AND d) AS n4 FROM k
)
SELECT 1 AS step_number, 'view' AS step, n1 AS entities, CAST(NULL AS DOUBLE) AS rate_from_previous FROM n
UNION ALL SELECT 2, 'click', n2, ROUND(n2 / NULLIF(n1, 0) * 100, 2) FROM n
UNION ALL SELECT 3, 'signup', n3, ROUND(n3 / NULLIF(n2, 0) * 100, 2) FROM n
UNION ALL SELECT 4, 'purchase', n4, ROUND(n4 / NULLIF(n3, 0) * 100, 2) FROM n""")
def _(s):
    visits = s.events.withColumn("visit", F.concat_ws("-", "user_id", F.to_date("ts")))
    return M.conversion_funnel(visits, "visit", ["view", "click", "signup", "purchase"])
