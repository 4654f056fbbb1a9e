"""Filters, joins, windows, sorts and set operations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from martloom.catalog.oracle import star
from martloom.catalog.registry import query
from martloom.functions import bands, variants
from martloom.functions import dates as D
from martloom.functions.measures import average, change_pct
from martloom.functions.tables import number_parts
from martloom.operators import keys as K
from martloom.operators import lineage, periods, shapes, slices
from martloom.plans import marts as M


# Filters

def _january(s):
    return s.fact_between(dt.date(2000, 1, 1), dt.date(2000, 2, 1))


@query("date_range_scan", star("""
SELECT COUNT(*) AS row_count, CAST(SUM(net_amount) AS DOUBLE) AS revenue
FROM fact_sales WHERE date_key BETWEEN 20000101 AND 20000131"""))
def _(s):
    return _january(s).agg(F.count("*").alias("row_count"), F.sum("net_amount").alias("revenue"))


@query("clustered_filter", star("""
SELECT COUNT(*) AS row_count, CAST(SUM(net_amount) AS DOUBLE) AS revenue
FROM fact_sales JOIN dim_store USING (store_key)
WHERE date_key BETWEEN 20000101 AND 20000131 AND region = 'ASIA'"""))
def _(s):
    asia = s.dim_store.filter("region = 'ASIA'").select("store_key")
    return K.semi(_january(s), asia, ["store_key"]).agg(
        F.count("*").alias("row_count"), F.sum("net_amount").alias("revenue"))


@query("point_lookup", star("""
SELECT customer_key, customer_id, full_name, email, customer_segment, loyalty_tier, region
FROM dim_customer WHERE customer_id = 'CUST-77' AND is_current"""))
def _(s):
    found = s.dim_customer.filter((F.col("customer_id") == "CUST-77") & F.col("is_current"))
    return found.select("customer_key", "customer_id", "full_name", "email", "customer_segment", "loyalty_tier",
                        "region")


@query("in_list", star("""
SELECT product_key, product_id, product_name FROM dim_product
WHERE product_id IN ('PROD-1', 'PROD-50', 'PROD-1001', 'PROD-none')"""))
def _(s):
    wanted = ["PROD-1", "PROD-50", "PROD-1001", "PROD-none"]
    return s.dim_product.filter(F.col("product_id").isin(wanted)).select("product_key", "product_id", "product_name")


@query("like_substring", star("""
SELECT product_key, product_name, brand FROM dim_product
WHERE product_name LIKE '%widget%' OR product_name LIKE '%bolt'"""))
def _(s):
    name = F.col("product_name")
    return s.dim_product.filter(name.contains("widget") | name.endswith("bolt")).select(
        "product_key", "product_name", "brand")


@query("regex_email_invalid", star(r"""
SELECT customer_key, email FROM dim_customer
WHERE email IS NOT NULL AND NOT regexp_full_match(email, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}')"""))
def _(s):
    return s.dim_customer.filter(shapes.invalid_email(F.col("email"))).select("customer_key", "email")


@query("like_email_invalid", star("""
SELECT customer_key, email FROM dim_customer WHERE email NOT LIKE '%_@_%.__%'"""))
def _(s):
    return s.dim_customer.filter(shapes.invalid_email_loose(F.col("email"))).select("customer_key", "email")


_STATES = "NY,CA,TX,IL,SC,CO,MN,ME,ZZ"


@query("case_bands", star("""
, x AS (SELECT *, (string_split('NY,CA,TX,IL,SC,CO,MN,ME,ZZ', ','))[1 + customer_key % 10] AS st FROM dim_customer)
SELECT customer_key, st AS state_code, loyalty_tier,
  CASE WHEN 2001 - year(date_of_birth) < 25 THEN '18-24' WHEN 2001 - year(date_of_birth) < 35 THEN '25-34'
    WHEN 2001 - year(date_of_birth) < 45 THEN '35-44' WHEN 2001 - year(date_of_birth) < 55 THEN '45-54'
    WHEN 2001 - year(date_of_birth) < 65 THEN '55-64' ELSE '65+' END AS age_group,
  CASE WHEN loyalty_points >= 10000 THEN 'HIGH_VALUE' WHEN loyalty_points >= 5000 THEN 'MEDIUM_VALUE'
    WHEN loyalty_points >= 1000 THEN 'LOW_VALUE' ELSE 'NEW_CUSTOMER' END AS value_tier,
  CASE st WHEN 'NY' THEN 'Northeast' WHEN 'CA' THEN 'West' WHEN 'TX' THEN 'South' WHEN 'IL' THEN 'Midwest'
    ELSE 'Other' END AS customer_region,
  CASE WHEN st IN ('NY', 'ME') THEN 'Northeast' WHEN st IN ('CA', 'CO') THEN 'West'
    WHEN st IN ('TX', 'SC') THEN 'South' WHEN st IN ('IL', 'MN') THEN 'Midwest' ELSE 'Other' END AS store_region
FROM x"""))
def _(s):
    codes = F.split(F.lit(_STATES), ",")
    state = F.get(codes, (F.col("customer_key") % 10).cast("int"))
    return s.dim_customer.withColumn("state_code", state).select(
        "customer_key", "state_code", "loyalty_tier",
        bands.age_group(F.col("date_of_birth"), D.day(s.as_of)).alias("age_group"),
        bands.value_tier(F.col("loyalty_points")).alias("value_tier"),
        bands.region_of(F.col("state_code")).alias("customer_region"),
        bands.region_of(F.col("state_code"), bands.STORE_REGIONS).alias("store_region"),
    )


@query("current_rows", star("SELECT customer_key, customer_id, region FROM dim_customer WHERE is_current"))
def _(s):
    return s.dim_customer.filter("is_current").select("customer_key", "customer_id", "region")


@query("active_products", star("""
SELECT product_key, product_id, category, CAST(unit_price AS DOUBLE) AS unit_price FROM dim_product WHERE is_active"""))
def _(s):
    return s.dim_product.filter("is_active").select("product_key", "product_id", "category", "unit_price")


@query("variant_paths", """
SELECT event_id, CAST(json_extract_string(doc, '$.payload.k') AS BIGINT) AS k,
  json_extract_string(doc, '$."event-type"') AS event_type,
  json_extract(doc, '$.payload.coupon') IS NOT NULL AS has_coupon
FROM (SELECT event_id, CAST('{"event-type":"' || event_type || '","payload":' ||
  CASE WHEN event_id % 5 = 0 THEN replace(props, '}', ', "coupon": "C5"}') ELSE props END || '}' AS JSON) AS doc
  FROM events)""")
def _(s):
    doc = variants.safe_json(_event_document())
    docs = s.events.select("event_id", doc.alias("doc"))
    return docs.select(
        "event_id",
        variants.path(F.col("doc"), "payload.k", "bigint").alias("k"),
        variants.path(F.col("doc"), "$['event-type']").alias("event_type"),
        variants.has_key(F.col("doc"), "payload.coupon").alias("has_coupon"),
    )


def _event_document():
    with_coupon = F.regexp_replace("props", r"\}", ', "coupon": "C5"}')
    payload = F.when(F.col("event_id") % 5 == 0, with_coupon).otherwise(F.col("props"))
    return F.concat(F.lit('{"event-type":"'), F.col("event_type"), F.lit('","payload":'), payload, F.lit("}"))


# Joins

@query("star_join", star("""
SELECT order_id, order_line_id, f.product_key, CAST(net_amount AS DOUBLE) AS net_amount, full_date, store_name, region,
  product_name, category
FROM fact_sales f JOIN dim_date USING (date_key) JOIN dim_store USING (store_key) JOIN dim_product USING (product_key)
"""))
def _(s):
    days = s.dim_date.select("date_key", "full_date")
    stores = K.small_side(s.dim_store.select("store_key", "store_name", "region"))
    products = K.small_side(s.dim_product.select("product_key", "product_name", "category"))
    joined = s.fact_sales.join(days, "date_key").join(stores, "store_key").join(products, "product_key")
    return joined.select("order_id", "order_line_id", "product_key", "net_amount", "full_date", "store_name",
                         "region", "product_name", "category")


@query("dim_left_join", star("""
SELECT p.product_key, p.category, COUNT(f.order_id) AS lines, MAX(full_date) AS last_sold
FROM dim_product p LEFT JOIN (SELECT * FROM fact_sales WHERE date_key BETWEEN 20000101 AND 20000131) f
  ON p.product_key = f.product_key LEFT JOIN dim_date d ON f.date_key = d.date_key GROUP BY 1, 2"""))
def _(s):
    days = s.dim_date.select("date_key", "full_date")
    sold = _january(s).join(days, "date_key", "left").groupBy("product_key").agg(
        F.count("*").alias("lines"), F.max("full_date").alias("last_sold"))
    return s.dim_product.select("product_key", "category").join(sold, "product_key", "left").fillna(0, ["lines"])


@query("key_lookup_join", star("""
SELECT o_orderkey AS order_id, c.customer_key, c.customer_segment
FROM orders LEFT JOIN (SELECT * FROM dim_customer WHERE is_current AND customer_segment <> 'MACHINERY') c
  ON c.customer_id = 'CUST-' || o_custkey"""))
def _(s):
    staged = s.table("orders").select(
        F.col("o_orderkey").alias("order_id"), F.concat(F.lit("CUST-"), F.col("o_custkey")).alias("customer_id"))
    return K.lookup(staged, s.dim_customer, "customer_id", ["customer_key", "customer_segment"],
                    "is_current AND customer_segment <> 'MACHINERY'").drop("customer_id")


@query("date_expr_join", star("""
SELECT event_id, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_key, o.orders
FROM events JOIN (SELECT CAST(o_orderdate AS DATE) + 8219 AS d, COUNT(*) AS orders FROM orders GROUP BY 1) o
  ON CAST(ts AS DATE) = o.d"""))
def _(s):
    per_day = s.table("orders").groupBy(F.date_add(F.to_date("o_orderdate"), 8219).alias("full_date")).agg(
        F.count("*").alias("orders"))
    events = s.events.select("event_id", F.to_date("ts").alias("full_date"))
    return events.join(per_day, "full_date").select(
        "event_id", D.date_key(F.col("full_date")).alias("date_key"), "orders")


@query("anti_orphans", """
SELECT 'lines of missing small parts' AS check_type, COUNT(*) AS orphan_count FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size > 5)
UNION ALL SELECT 'orders of missing customers', COUNT(*) FROM orders
WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal > 0)""")
def _(s):
    parts = s.table("part").filter("p_size > 5").select(F.col("p_partkey").alias("l_partkey"))
    payers = s.table("customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    return K.union_counts({
        "lines of missing small parts": K.orphan_rows(s.table("lineitem"), parts, "l_partkey"),
        "orders of missing customers": K.orphan_rows(s.table("orders"), payers, "o_custkey"),
    }, "check_type", "orphan_count")


@query("left_join_null_orphans", """
SELECT COUNT(*) AS checked, COUNT(*) FILTER (p_partkey IS NULL) AS orphans
FROM lineitem LEFT JOIN (SELECT p_partkey FROM part WHERE p_size > 5) ON p_partkey = l_partkey""")
def _(s):
    parts = s.table("part").filter("p_size > 5").select(F.col("p_partkey").alias("l_partkey"))
    return K.orphan_count(s.table("lineitem"), parts, "l_partkey")


@query("semi_in", """
SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)""")
def _(s):
    big = s.table("orders").filter("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return K.semi(s.table("customer"), big, ["c_custkey"]).select("c_custkey", "c_name")


@query("not_in", """
SELECT c_custkey, c_name FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_custkey IS NOT NULL)""")
def _(s):
    urgent = s.table("orders").filter("o_orderpriority = '1-URGENT'").select(
        F.when(F.col("o_custkey") >= 0, F.col("o_custkey")).alias("c_custkey"))
    return K.not_in(s.table("customer"), urgent, "c_custkey").select("c_custkey", "c_name")


@query("lateral_flatten", """
WITH e AS (SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type FROM events)
SELECT event_id, 'k' AS key, CAST(k AS VARCHAR) AS value FROM e
UNION ALL SELECT event_id, 'type', '"' || event_type || '"' FROM e""")
def _(s):
    doc = F.regexp_replace("props", r"\}$", F.concat(F.lit(', "type": "'), F.col("event_type"), F.lit('"}')))
    docs = s.events.select("event_id", variants.safe_json(doc).alias("doc"))
    return variants.flatten(docs, "doc").select("event_id", "key", F.to_json("value").alias("value"))


@query("recursive_join", """
WITH e AS (
  SELECT 'N' || n_nationkey AS s, 'C' || c_custkey AS t FROM nation JOIN customer ON c_nationkey = n_nationkey
  UNION ALL SELECT 'C' || o_custkey, 'O' || o_orderkey FROM orders
  UNION ALL SELECT 'O' || l_orderkey, 'P' || l_partkey FROM lineitem
)
SELECT DISTINCT 1 AS level, t AS object_path FROM e WHERE s = 'N3'
UNION ALL SELECT DISTINCT 2, b.t FROM e a JOIN e b ON a.t = b.s WHERE a.s = 'N3'
UNION ALL SELECT DISTINCT 3, c.t FROM e a JOIN e b ON a.t = b.s JOIN e c ON b.t = c.s WHERE a.s = 'N3'""")
def _(s):
    def edge(df, a, ka, b, kb):
        return df.select(F.concat(F.lit(a), F.col(ka)).alias("source_object"),
                         F.concat(F.lit(b), F.col(kb)).alias("target_object"))
    edges = (
        edge(s.table("customer"), "N", "c_nationkey", "C", "c_custkey")
        .unionByName(edge(s.table("orders"), "C", "o_custkey", "O", "o_orderkey"))
        .unionByName(edge(s.table("lineitem"), "O", "l_orderkey", "P", "l_partkey"))
        .withColumn("target_type", F.substring("target_object", 1, 1))
    )
    return lineage.impact(edges, "N3", 3).drop("object_type")


# Windows

_MONTHLY = """, m AS (SELECT month_start_date AS month, SUM(net_amount) AS revenue
  FROM fact_sales JOIN dim_date USING (date_key) GROUP BY 1)"""


def _monthly(s):
    months = s.dim_date.select("date_key", F.col("month_start_date").alias("month"))
    return s.fact_sales.join(months, "date_key").groupBy("month").agg(F.sum("net_amount").alias("revenue"))


@query("lag_change_pct", star(f"""{_MONTHLY}
, l AS (SELECT *, LAG(revenue) OVER (ORDER BY month) AS p, LAG(revenue, 12) OVER (ORDER BY month) AS y FROM m)
SELECT month, CAST(revenue AS DOUBLE) AS revenue, CAST(p AS DOUBLE) AS prev_month,
  ROUND((revenue - p) / NULLIF(p, 0) * 100, 2) AS mom_pct, CAST(y AS DOUBLE) AS same_month_ly,
  ROUND((revenue - y) / NULLIF(y, 0) * 100, 2) AS yoy_pct FROM l"""))
def _(s):
    out = periods.with_lag(_monthly(s), [], ["month"], "revenue", 1, "prev_month", "mom_pct")
    return periods.with_lag(out, [], ["month"], "revenue", 12, "same_month_ly", "yoy_pct")


@query("ytd_running_sum", star(f"""{_MONTHLY}
SELECT month, CAST(year(month) AS INTEGER) AS year, CAST(revenue AS DOUBLE) AS revenue,
  CAST(SUM(revenue) OVER (PARTITION BY year(month) ORDER BY month) AS DOUBLE) AS ytd_revenue FROM m"""))
def _(s):
    return periods.running_sum(_monthly(s).withColumn("year", F.year("month")), ["year"], ["month"], "revenue",
                               "ytd_revenue")


@query("moving_avg", star("""
, m AS (SELECT date_key, SUM(net_amount) AS revenue FROM fact_sales GROUP BY 1)
SELECT date_key, CAST(revenue AS DOUBLE) AS revenue,
  CAST((CAST(SUM(revenue) OVER a * 100 AS HUGEINT) * 2 + COUNT(*) OVER a) // (2 * COUNT(*) OVER a) AS DOUBLE) / 100
    AS moving_avg_7d,
  CAST((CAST(SUM(revenue) OVER b * 100 AS HUGEINT) * 2 + COUNT(*) OVER b) // (2 * COUNT(*) OVER b) AS DOUBLE) / 100
    AS moving_avg_30d
FROM m WINDOW a AS (ORDER BY date_key ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
  b AS (ORDER BY date_key ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)"""))
def _(s):
    daily = s.fact_sales.groupBy("date_key").agg(F.sum("net_amount").alias("revenue"))
    return periods.moving_average(daily, [], ["date_key"], "revenue", {"moving_avg_7d": 7, "moving_avg_30d": 30})


@query("rank_running_total", star("""
SELECT customer_key, order_id, order_line_id, CAST(net_amount AS DOUBLE) AS net_amount,
  ROW_NUMBER() OVER (PARTITION BY customer_key ORDER BY net_amount DESC, order_id, order_line_id, f.product_key,
    store_key) AS purchase_rank,
  CAST(SUM(net_amount) OVER (PARTITION BY customer_key ORDER BY date_key) AS DOUBLE) AS running_total
FROM fact_sales f"""))
def _(s):
    ranked = slices.rank_descending(s.fact_sales, ["customer_key"], "net_amount",
                                    ["order_id", "order_line_id", "product_key", "store_key"], "purchase_rank")
    total = slices.running_total(ranked, ["customer_key"], "date_key", "net_amount", "running_total")
    return total.select("customer_key", "order_id", "order_line_id", "net_amount", "purchase_rank", "running_total")


@query("top_n_per_group", star("""
, p AS (SELECT category, product_key, SUM(net_amount) AS total_revenue FROM fact_lines
  JOIN dim_product USING (product_key) GROUP BY 1, 2)
SELECT category, product_key, CAST(total_revenue AS DOUBLE) AS total_revenue,
  CAST(ROW_NUMBER() OVER w AS INTEGER) AS rank,
  CAST(DENSE_RANK() OVER (PARTITION BY category ORDER BY total_revenue DESC) AS INTEGER) AS dense_rank
FROM p QUALIFY rank <= 3 WINDOW w AS (PARTITION BY category ORDER BY total_revenue DESC, product_key)"""
.replace("QUALIFY rank <= 3 WINDOW w AS (PARTITION BY category ORDER BY total_revenue DESC, product_key)",
         "WINDOW w AS (PARTITION BY category ORDER BY total_revenue DESC, product_key) QUALIFY ROW_NUMBER() OVER w <= 3")))
def _(s):
    per_product = s.fact_lines.groupBy("product_key").agg(F.sum("net_amount").alias("total_revenue")).join(
        s.dim_product.select("product_key", "category"), "product_key")
    return K.top_per_group(per_product, ["category"], [F.desc("total_revenue"), F.asc("product_key")], 3,
                           F.desc("total_revenue"))


@query("latest_per_key", """
SELECT user_id, event_type, event_id, ts FROM events
QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
def _(s):
    return K.latest_per_key(s.events, ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")]).select(
        "user_id", "event_type", "event_id", "ts")


@query("window_over_agg", star("""
, q AS (SELECT year_number, quarter_name, month_name, month_start_date, COUNT(DISTINCT order_id) AS orders,
    SUM(net_amount) AS revenue FROM fact_sales JOIN dim_date USING (date_key) GROUP BY ALL),
l AS (SELECT *, LAG(revenue) OVER (ORDER BY month_start_date) AS p FROM q)
SELECT year_number, quarter_name, month_name, orders, CAST(revenue AS DOUBLE) AS revenue,
  CAST(p AS DOUBLE) AS prev_month_revenue, ROUND((revenue - p) / NULLIF(p, 0) * 100, 2) AS mom_growth_pct FROM l"""))
def _(s):
    months = s.dim_date.select("date_key", "year_number", "quarter_name", "month_name", "month_start_date")
    monthly = s.fact_sales.join(months, "date_key").groupBy(
        "year_number", "quarter_name", "month_name", "month_start_date"
    ).agg(F.countDistinct("order_id").alias("orders"), F.sum("net_amount").alias("revenue"))
    return periods.with_lag(monthly, [], ["month_start_date"], "revenue", 1, "prev_month_revenue",
                            "mom_growth_pct").drop("month_start_date")


def _session_oracle(minutes: int) -> str:
    return f"""
WITH f AS (SELECT *, CASE WHEN date_diff('minute', LAG(ts) OVER w, ts) <= {minutes} THEN 0 ELSE 1 END AS starts
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT event_id, user_id, ts, CAST(SUM(starts) OVER (PARTITION BY user_id ORDER BY ts, event_id
  ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_number FROM f"""


@query("sessionize", _session_oracle(30))
def _(s):
    return slices.sessionize(s.events, "user_id", "ts", "event_id", 30).select(
        "event_id", "user_id", "ts", "session_number")


@query("sessionize_12h", _session_oracle(720))
def _(s):
    return slices.sessionize(s.events, "user_id", "ts", "event_id", 720).select(
        "event_id", "user_id", "ts", "session_number")


@query("conditional_change_event", """
WITH f AS (SELECT *, CASE WHEN event_type <> LAG(event_type) OVER w THEN 1 ELSE 0 END AS c
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT event_id, user_id, event_type, CAST(SUM(c) OVER (PARTITION BY user_id ORDER BY ts, event_id
  ROWS UNBOUNDED PRECEDING) AS BIGINT) AS change_number FROM f""")
def _(s):
    return slices.change_count(s.events, "user_id", "ts", "event_id", "event_type").select(
        "event_id", "user_id", "event_type", "change_number")


_LINE_ORDER = "load_timestamp DESC, product_key, store_key, quantity, net_amount"


@query("dedup_latest", star(f"""
SELECT order_id, order_line_id, product_key, store_key, quantity, CAST(net_amount AS DOUBLE) AS net_amount
FROM fact_lines QUALIFY ROW_NUMBER() OVER (PARTITION BY order_id, order_line_id ORDER BY {_LINE_ORDER}) = 1"""))
def _(s):
    order = [F.desc("load_timestamp"), F.asc("product_key"), F.asc("store_key"), F.asc("quantity"),
             F.asc("net_amount")]
    return K.latest_per_key(s.fact_lines, ["order_id", "order_line_id"], order).select(
        "order_id", "order_line_id", "product_key", "store_key", "quantity", "net_amount")


@query("number_parts", """
SELECT p_partkey, CAST(i AS INTEGER) AS part_number, (string_split(p_name, ' '))[i] AS part_value
FROM part, LATERAL (SELECT UNNEST(range(1, len(string_split(p_name, ' ')) + 1)) AS i)""")
def _(s):
    words = s.table("part").select("p_partkey", F.split("p_name", " ").alias("words"))
    return number_parts(words, "words").drop("words")


# Aggregate forms

@query("having_duplicates", """
SELECT l_orderkey, l_linenumber, COUNT(*) AS cnt FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1""")
def _(s):
    return K.duplicates(s.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query("having_global", """
SELECT MAX(ts) AS last_event, COUNT(*) AS events FROM events HAVING MAX(ts) < TIMESTAMP '2024-02-01 00:00:00'""")
def _(s):
    totals = s.events.agg(F.max("ts").alias("last_event"), F.count("*").alias("events"))
    return totals.filter(F.col("last_event") < F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))


@query("pivot_months", star("""
SELECT year_number, """ + ", ".join(
    f"CAST(SUM(net_amount) FILTER (month_name = '{m}') AS DOUBLE) AS \"{m}\"" for m in shapes.MONTHS) + """
FROM fact_sales JOIN dim_date USING (date_key) GROUP BY 1"""))
def _(s):
    monthly = M.monthly_sales(s.fact_sales, s.dim_date, s.dim_store, s.dim_product)
    return shapes.pivot_sum(monthly, ["year_number"], "month_name", "net_revenue")


@query("unpivot_attributes", star("""
SELECT product_id, 'brand' AS attribute_name, brand AS attribute_value FROM dim_product WHERE brand IS NOT NULL
UNION ALL SELECT product_id, 'category', category FROM dim_product
UNION ALL SELECT product_id, 'big_size', CASE WHEN NOT is_active THEN subcategory END FROM dim_product
  WHERE NOT is_active"""))
def _(s):
    wide = s.dim_product.select("product_id", "brand", "category",
                                F.when(~F.col("is_active"), F.col("subcategory")).alias("big_size"))
    return shapes.unpivot(wide, ["product_id"], ["brand", "category", "big_size"])


# Sorts and sets

@query("order_by_limit", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""")
def _(s):
    return shapes.top(s.table("orders"), [F.desc("o_totalprice"), F.asc("o_orderkey")], 20).select(
        "o_orderkey", "o_custkey", "o_totalprice")


@query("order_by_case", """
SELECT event_id, event_type FROM events
ORDER BY CASE event_type WHEN 'error' THEN 0 WHEN 'purchase' THEN 1 ELSE 2 END, event_id DESC""")
def _(s):
    order = [shapes.by_rank("event_type", ["error", "purchase"]), F.desc("event_id")]
    return s.events.orderBy(*order).select("event_id", "event_type")


@query("union_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}" for t in ("lineitem", "orders", "customer", "part")))
def _(s):
    return K.union_counts({t: s.table(t) for t in ("lineitem", "orders", "customer", "part")})


@query("distinct", "SELECT DISTINCT l_returnflag, l_linestatus, l_suppkey FROM lineitem")
def _(s):
    return s.table("lineitem").select("l_returnflag", "l_linestatus", "l_suppkey").distinct()
