"""Quality rules, reconciliation and tests as queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from martloom.catalog.oracle import star
from martloom.catalog.registry import query
from martloom.operators import quality as Q
from martloom.plans import marts as M
from martloom.plans.stage import staged_customers, staged_sales

_STAGED = """, staged AS (
  SELECT order_id, order_line_id, product_key, quantity, unit_price, discount_percent,
    CASE WHEN quantity = 0 THEN 0 ELSE total END AS total_amount, payment_method
  FROM (SELECT CASE WHEN k % 101 <> 0 THEN 'ORD-' || order_id END AS order_id, order_line_id, product_key,
    CASE WHEN k % 103 = 0 THEN 0 WHEN k % 107 = 0 THEN NULL ELSE quantity END AS quantity,
    gross_amount AS unit_price, discount_percent,
    net_amount * quantity + CASE WHEN k % 109 = 0 THEN 5 ELSE 0 END AS total,
    (['CREDIT_CARD', 'DEBIT_CARD', 'CASH', 'PAYPAL', 'CHEQUE'])[1 + k % 5] AS payment_method
  FROM (SELECT *, order_id * 7 + order_line_id AS k FROM fact_lines))
), sales_faults AS (
  SELECT *, order_id IS NULL AS f1, quantity <= 0 AS f2,
    ABS(total_amount * 100 - unit_price * quantity * (100 - discount_percent)) > 1 AS f3,
    payment_method = 'CHEQUE' AS f4 FROM staged
), staged_customers AS (
  SELECT CASE WHEN customer_key % 89 <> 0 THEN customer_id END AS customer_id, email,
    CAST(registration_date + CAST(CASE WHEN customer_key % 83 = 0 THEN 9000 ELSE 0 END AS INTEGER) AS DATE)
      AS registration_date
  FROM dim_customer
)"""


def _rule(layer, table, rule, category, source, bad, note, threshold=100, grade=None, total="COUNT(*)"):
    rate = "(CAST(((t - f) * 20000 + t) // NULLIF(2 * t, 0) AS DOUBLE) / 100)"
    status = grade or "CASE WHEN f = 0 THEN 'PASS' ELSE 'FAIL' END"
    return f"""SELECT '{layer}' AS layer_name, '{table}' AS table_name, '{rule}' AS rule_name,
  '{category}' AS rule_category, t AS records_checked, t - f AS records_passed, f AS records_failed,
  {rate} AS pass_rate, {status.replace('RATE', rate)} AS status, CAST({threshold} AS DOUBLE) AS threshold,
  f || ' {note}' AS details
FROM (SELECT CAST({total} AS BIGINT) AS t, CAST({bad} AS BIGINT) AS f FROM {source})"""


def _all(*parts: str) -> str:
    return "\nUNION ALL\n".join(parts)


def _staging(table, rule, source, fault):
    return _rule("STAGING", table, rule, "VALIDITY", source, f"COUNT(*) FILTER ({fault})", "failed rows")


@query("dq_validate_sales", star(_STAGED + _all(*[
    _staging("STG_SALES", rule, "sales_faults", f"f{i + 1}") for i, rule in enumerate(
        ("ORDER_ID_NOT_NULL", "QUANTITY_POSITIVE", "AMOUNT_CALCULATION", "VALID_PAYMENT_METHOD"))])))
def _(s):
    return Q.validate_sales(staged_sales(s))


@query("dq_mark_sales", star(_STAGED + """
SELECT order_id, order_line_id, product_key, quantity,
  NOT (f1 OR COALESCE(f2, FALSE) OR COALESCE(f3, FALSE)) AS dq_is_valid,
  CASE WHEN f1 OR COALESCE(f2, FALSE) OR COALESCE(f3, FALSE) THEN 'Failed validation' END AS dq_error_details
FROM sales_faults"""))
def _(s):
    return Q.mark_sales(staged_sales(s)).select(
        "order_id", "order_line_id", "product_key", "quantity", "dq_is_valid", "dq_error_details")


@query("dq_validate_customers", star(_STAGED + _all(
    _staging("STG_CUSTOMERS", "CUSTOMER_ID_NOT_NULL", "staged_customers", "customer_id IS NULL"),
    _staging("STG_CUSTOMERS", "VALID_EMAIL_FORMAT", "staged_customers", "email NOT LIKE '%@%'"),
    _staging("STG_CUSTOMERS", "REGISTRATION_NOT_FUTURE", "staged_customers",
             "registration_date > DATE '2001-07-31'"))))
def _(s):
    return Q.validate_customers(staged_customers(s), s.as_of)


_BANDED = "CASE WHEN RATE >= 95 THEN 'PASS' WHEN RATE >= 90 THEN 'WARNING' ELSE 'FAIL' END"
_AT_99 = "CASE WHEN RATE >= 99 THEN 'PASS' ELSE 'FAIL' END"
_SOFT = "CASE WHEN f = 0 THEN 'PASS' ELSE 'WARNING' END"

COMPLETENESS = _all(
    _rule("CURATED", "DIM_CUSTOMER", "EMAIL_NOT_NULL", "COMPLETENESS", "dim_customer WHERE is_current",
          "COUNT(*) - COUNT(email)", "customers missing email", 95, _BANDED),
    _rule("CURATED", "FACT_SALES", "REQUIRED_FIELDS_NOT_NULL", "COMPLETENESS", "fact_sales",
          "COUNT(*) FILTER (date_key IS NULL OR order_id IS NULL OR net_amount IS NULL)",
          "records missing required fields (date_key, order_id, net_amount)", 99, _AT_99),
    _rule("CURATED", "DIM_PRODUCT", "PRODUCT_NAME_NOT_NULL", "COMPLETENESS", "dim_product",
          "COUNT(*) - COUNT(product_name)", "products missing name", 99, _AT_99))


@query("dq_completeness", star(COMPLETENESS))
def _(s):
    return Q.completeness(s.dim_customer, s.fact_sales, s.dim_product)


UNIQUENESS = _all(
    _rule("CURATED", "DIM_CUSTOMER", "UNIQUE_CUSTOMER_ID_CURRENT", "UNIQUENESS", "dim_customer WHERE is_current",
          "COUNT(*) - COUNT(DISTINCT customer_id)", "duplicate customer_ids in current records"),
    _rule("CURATED", "FACT_SALES", "UNIQUE_ORDER_LINE", "UNIQUENESS", "fact_lines",
          "COUNT(*) - COUNT(DISTINCT order_id || '-' || order_line_id)", "duplicate order line records"),
    _rule("CURATED", "DIM_DATE", "UNIQUE_DATE_KEY", "UNIQUENESS", "dim_date",
          "COUNT(*) - COUNT(DISTINCT date_key)", "duplicate date keys"))


@query("dq_uniqueness", star(UNIQUENESS))
def _(s):
    return Q.uniqueness(s.dim_customer, s.fact_lines, s.dim_date)


ACCURACY = _all(
    _rule("CURATED", "FACT_SALES", "NET_AMOUNT_POSITIVE", "ACCURACY", "fact_lines",
          "COUNT(*) FILTER (net_amount < 0)", "records with negative net_amount", 99, _SOFT),
    _rule("CURATED", "FACT_SALES", "QUANTITY_IN_RANGE", "ACCURACY", "fact_lines",
          "COUNT(*) FILTER (quantity < 1 OR quantity > 1000)", "records with quantity outside 1-1000 range", 99, _SOFT),
    _rule("CURATED", "FACT_SALES", "DISCOUNT_PCT_IN_RANGE", "ACCURACY", "fact_lines",
          "COUNT(*) FILTER (discount_percent < 0 OR discount_percent > 100)",
          "records with discount_percent outside 0-100 range"),
    _rule("CURATED", "DIM_CUSTOMER", "EMAIL_FORMAT_VALID", "ACCURACY",
          "dim_customer WHERE is_current AND email IS NOT NULL", "COUNT(*) FILTER (email NOT LIKE '%_@_%.__%')",
          "customers with invalid email format", 98, _SOFT))


@query("dq_accuracy", star(ACCURACY))
def _(s):
    return Q.accuracy(s.dim_customer, s.fact_lines)


def _fk(rule, key, parent, null_rule):
    return _rule("CURATED", "FACT_SALES", rule, "CONSISTENCY",
                 f"fact_sales f LEFT JOIN {parent} d ON d.{key} = f.{key} {null_rule}",
                 f"COUNT(*) FILTER (d.{key} IS NULL)", f"orphan {key} references in FACT_SALES")


CONSISTENCY = _all(
    _fk("FK_CUSTOMER_INTEGRITY", "customer_key", "dim_customer", "WHERE f.customer_key IS NOT NULL"),
    _fk("FK_PRODUCT_INTEGRITY", "product_key", "part_gap", "WHERE f.product_key IS NOT NULL"),
    _fk("FK_DATE_INTEGRITY", "date_key", "dim_date", ""),
    _rule("CURATED", "DIM_CUSTOMER", "SCD2_ONE_CURRENT_PER_KEY", "CONSISTENCY",
          "(SELECT customer_id, COUNT(*) AS cnt FROM dim_customer WHERE is_current GROUP BY 1)",
          "COUNT(*) FILTER (cnt > 1)", "customers with multiple current records"))
_GAP = ", part_gap AS (SELECT * FROM dim_product WHERE subcategory <> 'SIZE-0')\n"


def _known_products(s):
    return s.dim_product.filter("subcategory <> 'SIZE-0'")


@query("dq_consistency", star(_GAP + CONSISTENCY))
def _(s):
    return Q.consistency(s.dim_customer, s.fact_sales, _known_products(s), s.dim_date)


_NOW = dt.datetime(2024, 1, 30, 12)
TIMELINESS = """SELECT 'CURATED' AS layer_name, 'FACT_CLICKSTREAM' AS table_name, 'DATA_FRESHNESS_24H' AS rule_name,
  'TIMELINESS' AS rule_category, CAST(1 AS BIGINT) AS records_checked, CAST(ok AS BIGINT) AS records_passed,
  CAST(1 - ok AS BIGINT) AS records_failed, CAST(ok * 100 AS DOUBLE) AS pass_rate,
  CASE ok WHEN 1 THEN 'PASS' ELSE 'FAIL' END AS status, CAST(100 AS DOUBLE) AS threshold,
  'Last load timestamp: ' || strftime(last, '%Y-%m-%d %H:%M:%S') AS details
FROM (SELECT MAX(ts) AS last, CASE WHEN MAX(ts) >= TIMESTAMP '2024-01-29 12:00:00' THEN 1 ELSE 0 END AS ok
  FROM events)"""


@query("dq_timeliness", TIMELINESS)
def _(s):
    return Q.timeliness(s.events, "FACT_CLICKSTREAM", "ts", _NOW)


def _log(s):
    """Two runs of the checks, a day apart."""
    first = [Q.uniqueness(s.dim_customer, s.fact_lines, s.dim_date), Q.accuracy(s.dim_customer, s.fact_lines)]
    second = [Q.uniqueness(s.dim_customer, s.fact_lines, s.dim_date), Q.timeliness(s.events, "FACT_CLICKSTREAM", "ts",
                                                                                   _NOW)]
    return Q.run_all(first, "run-1", _NOW).unionByName(Q.run_all(second, "run-2", _NOW + dt.timedelta(days=1)))


_LOG = f""", log AS (
  SELECT *, 'run-1' AS run_id, TIMESTAMP '2024-01-30 12:00:00' AS validation_timestamp
    FROM ({UNIQUENESS} UNION ALL {ACCURACY})
  UNION ALL SELECT *, 'run-2', TIMESTAMP '2024-01-31 12:00:00' FROM ({UNIQUENESS} UNION ALL {TIMELINESS})
)
"""


@query("dq_run_all", star(_LOG + "SELECT * FROM log"))
def _(s):
    return _log(s)


@query("dq_failures", star(_LOG + "SELECT COUNT(*) AS failures FROM log WHERE run_id = 'run-2' AND status = 'FAIL'"))
def _(s):
    return Q.failures(_log(s), "run-2")


@query("dq_latest", star(_LOG + """
SELECT validation_timestamp, layer_name, table_name, rule_name, rule_category, records_checked, records_failed,
  pass_rate, status, threshold, details FROM log
QUALIFY ROW_NUMBER() OVER (PARTITION BY table_name, rule_name ORDER BY validation_timestamp DESC) = 1"""))
def _(s):
    return Q.latest_results(_log(s))


@query("dq_daily_summary", star(_LOG + """
SELECT CAST(validation_timestamp AS DATE) AS check_date, rule_category, COUNT(*) AS total_checks,
  COUNT(*) FILTER (status = 'PASS') AS passed, COUNT(*) FILTER (status = 'WARNING') AS warnings,
  COUNT(*) FILTER (status = 'FAIL') AS failed,
  ROUND(COUNT(*) FILTER (status = 'PASS') / COUNT(*) * 100, 2) AS overall_pass_rate FROM log GROUP BY ALL"""))
def _(s):
    return Q.daily_summary(_log(s))


def _short(name, source, bad, note, style="check"):
    inner = f"(SELECT CAST({bad} AS BIGINT) AS n FROM {source})"
    status = "CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS status"
    if style == "check":
        return f"SELECT '{name}' AS check_name, {status}, n AS error_count, '{note}' AS details FROM {inner}"
    return f"SELECT '{name}' AS test_name, {status}, n || ' {note}' AS details FROM {inner}"


@query("dq_curated_checks", star(_all(
    _short("Orphan Customer Keys", "fact_sales WHERE customer_key NOT IN (SELECT customer_key FROM dim_customer)",
           "COUNT(*)", "Fact records without matching customer dimension"),
    _short("Negative Net Amounts", "fact_sales", "COUNT(*) FILTER (net_amount < 0)", "Sales with negative net_amount"),
    _short("Future Transaction Dates", "fact_sales JOIN dim_date USING (date_key)",
           "COUNT(*) FILTER (full_date > DATE '2001-07-31')", "Transactions dated in the future"),
    _short("Duplicate Order Lines",
           "(SELECT 1 FROM fact_lines GROUP BY order_id, order_line_id HAVING COUNT(*) > 1)", "COUNT(*)",
           "Duplicate order_id + order_line_id combinations"))))
def _(s):
    return Q.curated_checks(s.fact_sales, s.dim_customer, s.dim_date, s.as_of)


@query("test_fk", star(_GAP + _all(
    _short("FACT_SALES_CUSTOMER_FK", "fact_sales WHERE customer_key NOT IN (SELECT customer_key FROM dim_customer)",
           "COUNT(*)", "orphan records", "test"),
    _short("FACT_SALES_PRODUCT_FK", "fact_sales WHERE product_key NOT IN (SELECT product_key FROM part_gap)",
           "COUNT(*)", "orphan records", "test"),
    _short("FACT_SALES_DATE_FK", "fact_sales f LEFT JOIN dim_date d ON d.date_key = f.date_key",
           "COUNT(*) FILTER (d.date_key IS NULL)", "orphan records", "test"))))
def _(s):
    return Q.foreign_key_tests(s.fact_sales, s.dim_customer, _known_products(s), s.dim_date)


@query("reconcile_counts", star(_STAGED + """
SELECT 'STAGING' AS layer, 'STG_SALES' AS table_name,
  COUNT(*) FILTER (NOT (f1 OR COALESCE(f2, FALSE) OR COALESCE(f3, FALSE))) AS row_count FROM sales_faults
UNION ALL SELECT 'CURATED', 'FACT_SALES', COUNT(*) FROM fact_sales
UNION ALL SELECT 'STAGING', 'STG_CUSTOMERS',
  COUNT(*) FILTER (customer_id IS NOT NULL AND registration_date <= DATE '2001-07-31') FROM staged_customers
UNION ALL SELECT 'CURATED', 'DIM_CUSTOMER (current)', COUNT(*) FROM dim_customer WHERE is_current"""))
def _(s):
    return Q.reconcile_counts(Q.mark_sales(staged_sales(s)), s.fact_sales,
                              Q.mark_customers(staged_customers(s), s.as_of), s.dim_customer)


@query("test_data_flow", star(_STAGED + """
, v AS (SELECT COUNT(*) FILTER (NOT (f1 OR COALESCE(f2, FALSE) OR COALESCE(f3, FALSE))) AS s FROM sales_faults),
c AS (SELECT COUNT(*) AS c FROM fact_sales),
d AS (SELECT COUNT(*) AS n FROM (SELECT 1 FROM fact_sales JOIN dim_date USING (date_key) GROUP BY date_key))
SELECT 'SALES_ROW_COUNT_MATCH' AS test_name, CASE WHEN abs(s - c) / s < 0.01 THEN 'PASS' ELSE 'FAIL' END AS status,
  'Staging valid rows: ' || s || ', Curated rows: ' || c AS details FROM v, c
UNION ALL SELECT 'DATE_DIM_COVERAGE', CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END,
  n || ' fact records with dates not in DIM_DATE'
  FROM (SELECT COUNT(*) FILTER (d.date_key IS NULL) AS n FROM fact_sales f LEFT JOIN dim_date d
    ON d.date_key = f.date_key)
UNION ALL SELECT 'CUSTOMER_DIM_HAS_CURRENT', 'PASS', COUNT(*) || ' current customer records' FROM dim_customer
UNION ALL SELECT 'MV_DAILY_SALES_POPULATED', 'PASS', n || ' rows in MV_DAILY_SALES_SUMMARY' FROM d""".replace("\n, v", ", v")))
def _(s):
    daily = M.shared_sales_summary(s.fact_sales, s.dim_date, s.dim_store, s.dim_product).select("sale_date").distinct()
    return Q.data_flow_tests(Q.mark_sales(staged_sales(s)), s.fact_sales, s.dim_date, s.dim_customer, daily)


@query("test_transform_logic", star(_all(
    _short("GROSS_AMOUNT_CALC", "fact_sales", "COUNT(*) FILTER (ABS(gross_amount - unit_price * quantity) > 0.01)",
           "records where gross_amount != unit_price * quantity", "test"),
    _short("NET_LESS_THAN_GROSS", "fact_sales", "COUNT(*) FILTER (net_amount > gross_amount + 0.01)",
           "records where net_amount > gross_amount", "test"),
    _short("SCD2_DATE_CONTINUITY", "dim_customer WHERE is_current", "COUNT(*) FILTER (end_date IS NOT NULL)",
           "customers with date gaps in SCD2 history", "test"),
    _short("SCD2_VERSION_GAPS", "dim_customer WHERE FALSE", "COUNT(*)", "versions not followed by the next day",
           "test"),
    _short("PROFIT_MARGIN_VALID", "dim_product", "COUNT(*) FILTER (profit_margin < 0 OR profit_margin > 100)",
           "products with profit_margin outside 0-100 range", "test"))))
def _(s):
    return Q.transform_tests(s.fact_sales, s.dim_product, s.dim_customer)


@query("test_latest", """
SELECT event_type AS test_suite, 'T' || user_id AS test_name,
  CASE WHEN value > 20 THEN 'FAIL' WHEN value > 15 THEN 'SKIP' ELSE 'PASS' END AS status, ts AS test_timestamp
FROM events QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1""")
def _(s):
    status = F.when(F.col("value") > 20, "FAIL").when(F.col("value") > 15, "SKIP").otherwise("PASS")
    return Q.latest_tests(s.events.select(
        F.col("event_type").alias("test_suite"), F.concat(F.lit("T"), "user_id").alias("test_name"),
        status.alias("status"), F.col("ts").alias("test_timestamp")))


@query("agg_reconcile", star("""
SELECT 'SUMMARY_TOTAL_MATCH' AS test_name, 'PASS' AS status, CAST(SUM(net_amount) AS DOUBLE) AS fact_total,
  CAST(SUM(net_amount) AS DOUBLE) AS summary_total FROM fact_sales JOIN dim_date USING (date_key)"""))
def _(s):
    summary = M.monthly_revenue_by_store(s.fact_sales, s.dim_date, s.dim_store)
    return Q.reconcile_sums(s.fact_sales, summary, "net_amount", "revenue")


@query("agg_missing_days", star("""
SELECT full_date FROM dim_date WHERE full_date BETWEEN DATE '1995-01-01' AND DATE '2001-12-31'
  AND full_date NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders)"""))
def _(s):
    days = s.table("orders").select(F.to_date("o_orderdate").alias("sale_date"))
    return Q.missing_days(s.dim_date, days, "sale_date", dt.date(1995, 1, 1), dt.date(2001, 12, 31))
