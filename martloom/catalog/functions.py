"""Scalar, table and access functions; masks."""

from __future__ import annotations

from pyspark.sql import functions as F

from martloom.catalog.oracle import mean, star
from martloom.catalog.registry import query
from martloom.functions import bands, casts, hashing, masks, measures, tables, variants
from martloom.functions import dates as D
from martloom.operators import access as A
from martloom.plans import secure as S

# Scalar functions


@query("fn_strings", """
SELECT p_partkey, upper(p_name) AS up, trim('  ' || p_name || ' ') AS trimmed, lower(p_brand) AS low,
  p_brand || '/' || p_type AS joined, concat_ws('|', p_brand, p_type, CAST(p_size AS VARCHAR)) AS piped,
  left(p_name, 3) AS l3, right(p_name, 3) AS r3, substring(p_name, 2, 3) AS mid, CAST(length(p_name) AS INTEGER) AS len,
  repeat('*', p_size % 5) AS stars, CAST(position(' ' IN p_name) AS INTEGER) AS blank,
  split_part(p_name, ' ', 2) AS second, regexp_replace(p_brand, '[0-9]', '#', 'g') AS no_digits,
  regexp_matches(p_name, '^(red|blue) ') AS coloured, COALESCE(NULLIF(p_type, 'PROMO'), 'none') AS type_or_none,
  upper(left(p_type, 1)) || lower(substring(p_type, 2)) AS capital
FROM part""")
def _(s):
    name, brand, kind = F.col("p_name"), F.col("p_brand"), F.col("p_type")
    return s.table("part").select(
        "p_partkey",
        F.upper(name).alias("up"),
        F.trim(F.concat(F.lit("  "), name, F.lit(" "))).alias("trimmed"),
        F.lower(brand).alias("low"),
        F.concat(brand, F.lit("/"), kind).alias("joined"),
        F.concat_ws("|", brand, kind, F.col("p_size").cast("string")).alias("piped"),
        F.left(name, F.lit(3)).alias("l3"),
        F.right(name, F.lit(3)).alias("r3"),
        F.substring(name, 2, 3).alias("mid"),
        F.length(name).alias("len"),
        F.repeat(F.lit("*"), F.col("p_size") % 5).alias("stars"),
        F.position(F.lit(" "), name).alias("blank"),
        F.split_part(name, F.lit(" "), F.lit(2)).alias("second"),
        F.regexp_replace(brand, "[0-9]", "#").alias("no_digits"),
        name.rlike("^(red|blue) ").alias("coloured"),
        F.coalesce(F.nullif(kind, F.lit("PROMO")), F.lit("none")).alias("type_or_none"),
        F.initcap(kind).alias("capital"),
    )


@query("fn_dates", """
SELECT o_orderkey, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(year(d) AS INTEGER) AS y,
  CAST(quarter(d) AS INTEGER) AS q, CAST(month(d) AS INTEGER) AS m, CAST(day(d) AS INTEGER) AS dd,
  CAST(dayofyear(d) AS INTEGER) AS doy, CAST(dayofweek(d) AS INTEGER) AS dow, CAST(weekofyear(d) AS INTEGER) AS woy,
  strftime(d, '%a') AS day_name, strftime(d, '%b') AS month_name, last_day(d) AS month_end,
  CAST(date_trunc('week', d) AS DATE) AS week_start, make_date(year(d), month(d), 1) AS month_start,
  CAST(d + 30 AS DATE) AS plus_30, CAST(d + INTERVAL 1 MONTH AS DATE) AS next_month,
  CAST(date_diff('day', d, DATE '2001-07-31') AS INTEGER) AS days_to,
  CAST(date_diff('month', d, DATE '2001-07-31') AS INTEGER) AS months_to,
  CAST(date_diff('year', d, DATE '2001-07-31') AS INTEGER) AS years_to,
  d + INTERVAL 3661 SECOND AS plus_seconds
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""")
def _(s):
    end = D.day(s.as_of)
    days = s.table("orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    d = F.col("d")
    return days.select(
        "o_orderkey", D.date_key(d).alias("date_key"), F.year(d).alias("y"), F.quarter(d).alias("q"),
        F.month(d).alias("m"), F.dayofmonth(d).alias("dd"), F.dayofyear(d).alias("doy"),
        D.weekday_from_sunday(d).alias("dow"), F.weekofyear(d).alias("woy"), F.dayname(d).alias("day_name"),
        F.monthname(d).alias("month_name"), F.last_day(d).alias("month_end"), D.week_start(d).alias("week_start"),
        F.trunc(d, "month").alias("month_start"), F.date_add(d, 30).alias("plus_30"),
        F.add_months(d, 1).alias("next_month"), F.datediff(end, d).alias("days_to"),
        D.months_crossed(d, end).alias("months_to"), D.years_crossed(d, end).alias("years_to"),
        (d.cast("timestamp_ntz") + F.make_dt_interval(secs=F.lit(3661))).alias("plus_seconds"),
    )


_RAW_TEXT = "CASE event_id % 6 WHEN 0 THEN 'bad' WHEN 1 THEN '' ELSE CAST(value AS VARCHAR) END"


@query("fn_try_casts", f"""
SELECT event_id, TRY_CAST(CAST(TRY_CAST({_RAW_TEXT} AS DOUBLE) AS DECIMAL(38,0)) AS BIGINT) AS as_number,
  CAST(CAST(TRY_CAST({_RAW_TEXT} AS DOUBLE) AS DECIMAL(12,1)) AS DOUBLE) AS as_decimal,
  TRY_CAST(CASE WHEN event_id % 4 = 0 THEN '2024-13-40' ELSE CAST(CAST(ts AS DATE) AS VARCHAR) END AS DATE) AS as_date,
  TRY_CAST(CASE WHEN event_id % 4 = 0 THEN 'soon' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS TIMESTAMP) AS as_ts,
  CASE event_id % 5 WHEN 0 THEN TRUE WHEN 1 THEN FALSE WHEN 2 THEN TRUE WHEN 3 THEN FALSE END AS as_boolean
FROM events""")
def _(s):
    e = F.col("event_id")
    text = F.when(e % 6 == 0, "bad").when(e % 6 == 1, "").otherwise(F.col("value").cast("string"))
    day = F.when(e % 4 == 0, "2024-13-40").otherwise(F.date_format("ts", "yyyy-MM-dd"))
    stamp = F.when(e % 4 == 0, "soon").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    words = F.get(F.array(*[F.lit(w) for w in ("true", "no", "on", "Off", "maybe")]), (e % 5).cast("int"))
    return s.events.select(
        "event_id",
        casts.try_number(text).alias("as_number"),
        casts.try_decimal(text, 12, 1).alias("as_decimal"),
        casts.try_date(day).alias("as_date"),
        casts.try_timestamp(stamp).alias("as_ts"),
        casts.try_boolean(words).alias("as_boolean"),
    )


@query("fn_json", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
  '{"event_id":' || event_id || ',"metrics":{"type":"' || event_type || '","k":' || json_extract_string(props, '$.k')
    || '}}' AS built,
  CAST(1 + event_id % 3 AS INTEGER) AS parts, event_id % 7 = 0 AS broken
FROM events""")
def _(s):
    doc = F.when(F.col("event_id") % 7 == 0, F.concat(F.col("props"), F.lit("}"))).otherwise(F.col("props"))
    k = variants.path(F.parse_json("props"), "k", "bigint")
    built = variants.build_object({"event_id": F.col("event_id"), "metrics": {"type": F.col("event_type"), "k": k}})
    return s.events.select(
        "event_id", k.alias("k"), built.alias("built"),
        F.size(F.array_repeat("event_type", (1 + F.col("event_id") % 3).cast("int"))).alias("parts"),
        variants.safe_json(doc).isNull().alias("broken"),
    )


@query("fn_hash", """
SELECT c_custkey, md5(concat_ws('|', COALESCE(c_name, ''), COALESCE(c_mktsegment, ''),
    COALESCE(CASE WHEN c_custkey % 3 > 0 THEN CAST(c_nationkey AS VARCHAR) END, ''))) AS record_hash,
  sha256(c_name) AS name_sha2
FROM customer""")
def _(s):
    nation = F.when(F.col("c_custkey") % 3 > 0, F.col("c_nationkey"))
    return s.table("customer").select(
        "c_custkey", hashing.record_hash(["c_name", "c_mktsegment", nation]).alias("record_hash"),
        hashing.pseudonym(F.col("c_name")).alias("name_sha2"))


# User functions

@query("udf_age", star("""
SELECT customer_key, CAST(date_diff('year', date_of_birth, DATE '2001-07-31') -
  CASE WHEN strftime(DATE '2001-07-31', '%m%d') < strftime(date_of_birth, '%m%d') THEN 1 ELSE 0 END AS INTEGER) AS age
FROM dim_customer"""))
def _(s):
    return s.dim_customer.select(
        "customer_key", D.completed_years(F.col("date_of_birth"), D.day(s.as_of)).alias("age"))


@query("udf_value_tier", star("""
, v AS (SELECT customer_key, SUM(net_amount) / 100 AS ltv FROM fact_sales GROUP BY 1)
SELECT customer_key, CASE WHEN ltv >= 10000 THEN 'HIGH_VALUE' WHEN ltv >= 5000 THEN 'MEDIUM_VALUE'
  WHEN ltv >= 1000 THEN 'LOW_VALUE' ELSE 'NEW_CUSTOMER' END AS tier FROM v"""))
def _(s):
    ltv = s.fact_sales.groupBy("customer_key").agg((F.sum("net_amount") / 100).alias("ltv"))
    return ltv.select("customer_key", bands.value_tier(F.col("ltv")).alias("tier"))


@query("udf_discount_pct", star("""
SELECT order_id, order_line_id, product_key, CASE WHEN gross_amount > 0
  THEN ROUND((1 - net_amount / gross_amount) * 100, 2) ELSE 0 END AS pct FROM fact_lines"""))
def _(s):
    pct = measures.discount_pct(F.col("gross_amount"), F.col("net_amount"))
    return s.fact_lines.select("order_id", "order_line_id", "product_key", pct.alias("pct"))


@query("udf_mask_email", star("""
SELECT customer_key, CASE WHEN mail IS NULL THEN NULL WHEN position('@' IN mail) > 2
  THEN left(mail, 2) || '***' || substring(mail, position('@' IN mail)) ELSE '***@***' END AS masked
FROM (SELECT customer_key, CASE WHEN customer_key % 9 = 0 THEN 'a@b.com' ELSE email END AS mail FROM dim_customer)"""))
def _(s):
    mail = F.when(F.col("customer_key") % 9 == 0, "a@b.com").otherwise(F.col("email"))
    return s.dim_customer.select("customer_key", masks.shorten_email(mail).alias("masked"))


@query("udf_safe_json", """
SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE replace(props, ' ', '') END AS doc FROM events""")
def _(s):
    text = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("{"), F.col("props"))).otherwise(F.col("props"))
    return s.events.select("event_id", variants.safe_json(text).alias("doc"))


@query("udf_levenshtein", """
SELECT p_partkey, CAST(levenshtein(p_name, p_type) AS INTEGER) AS distance FROM part""")
def _(s):
    return s.table("part").select("p_partkey", F.levenshtein("p_name", "p_type").alias("distance"))


@query("udtf_date_range", """
SELECT d AS date_value, COUNT(event_id) AS events
FROM (SELECT CAST(DATE '2023-12-25' + CAST(i AS INTEGER) AS DATE) AS d FROM range(50) t(i))
  LEFT JOIN events ON CAST(ts AS DATE) = d GROUP BY 1""")
def _(s):
    per_day = s.events.groupBy(F.to_date("ts").alias("date_value")).agg(F.count("*").alias("events"))
    days = tables.date_range(s.spark, "2023-12-25", "2024-02-12")
    return days.join(per_day, "date_value", "left").fillna(0, ["events"])


@query("udtf_split", """
SELECT p_partkey, CAST(i AS INTEGER) AS part_number, (string_split(t, '.*'))[i] AS part_value
FROM (SELECT p_partkey, replace(p_name, ' ', '.*') || '.*' || p_brand AS t FROM part),
  LATERAL (SELECT UNNEST(range(1, len(string_split(t, '.*')) + 1)) AS i)""")
def _(s):
    text = F.concat(F.replace(F.col("p_name"), F.lit(" "), F.lit(".*")), F.lit(".*"), F.col("p_brand"))
    return tables.split_parts(s.table("part").select("p_partkey", text.alias("t")), F.col("t"), ".*").drop("t")


_MAPPING_SQL = """mapping AS (SELECT 'U' || n_nationkey AS user_name,
  CASE WHEN n_nationkey % 6 = 0 THEN NULL WHEN n_nationkey % 6 = 1 THEN 'ALL' ELSE r_name END AS region,
  CASE WHEN n_nationkey % 6 = 0 THEN 'FULL' ELSE 'REGION_ONLY' END AS access_level
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""


def _mapping(s):
    key = F.col("n_nationkey")
    region = F.when(key % 6 == 0, None).when(key % 6 == 1, "ALL").otherwise(F.col("region"))
    return s.places.select(
        F.concat(F.lit("U"), key).alias("user_name"), region.alias("region"),
        F.when(key % 6 == 0, "FULL").otherwise("REGION_ONLY").alias("access_level"))


@query("user_region", f"""
WITH {_MAPPING_SQL}
SELECT user_name, COALESCE(region, 'ALL') AS region FROM mapping WHERE user_name = 'U2'
UNION ALL SELECT 'nobody', 'ALL' UNION ALL SELECT 'U6', 'ALL'""")
def _(s):
    out = None
    for user in ("U2", "nobody", "U6"):
        row = s.spark.range(1).select(F.lit(user).alias("user_name"),
                                      tables.user_region(_mapping(s), user).alias("region"))
        out = row if out is None else out.unionByName(row)
    return out


@query("can_access_region", star(f"""
, {_MAPPING_SQL}
SELECT store_key, region, region = (SELECT region FROM mapping WHERE user_name = 'U2') AS allowed FROM dim_store"""))
def _(s):
    return s.dim_store.select("store_key", "region",
                              tables.can_access_region(_mapping(s), "U2", F.col("region")).alias("allowed"))


# Masks: one row per customer and role

_ROLES = ("RETAIL_ADMIN", "RETAIL_ENGINEER", "RETAIL_ANALYST", "RETAIL_VIEWER")


def _per_role(df, keep, masker):
    out = None
    for role in _ROLES:
        part = df.select(keep, F.lit(role).alias("role"), masker(role).alias("masked"))
        out = part if out is None else out.unionByName(part)
    return out


def _role_sql(expression: str, source: str = "dim_customer") -> str:
    return star(f"""SELECT customer_key, role, {expression} AS masked
FROM {source}, (SELECT UNNEST(['RETAIL_ADMIN', 'RETAIL_ENGINEER', 'RETAIL_ANALYST', 'RETAIL_VIEWER']) AS role)""")


_TWO_SQL = "left(email, 2) || '****@' || split_part(email, '@', 2)"


@query("mask_email", _role_sql(f"""CASE WHEN role IN ('RETAIL_ADMIN', 'RETAIL_ENGINEER') THEN email
  WHEN role = 'RETAIL_ANALYST' THEN {_TWO_SQL} ELSE '****@****.***' END"""))
def _(s):
    return _per_role(s.dim_customer, "customer_key", lambda role: masks.mask_email(F.col("email"), role))


@query("mask_phone", _role_sql("""CASE WHEN role IN ('RETAIL_ADMIN', 'RETAIL_ENGINEER') THEN phone
  ELSE regexp_replace(phone, '[0-9]', '*', 'g') END"""))
def _(s):
    return _per_role(s.dim_customer, "customer_key", lambda role: masks.mask_phone(F.col("phone"), role))


@query("mask_name", _role_sql("""CASE WHEN role IN ('RETAIL_ADMIN', 'RETAIL_ENGINEER') THEN full_name
  WHEN role = 'RETAIL_ANALYST' THEN left(full_name, 1) || repeat('*', length(full_name) - 1) ELSE '****' END"""))
def _(s):
    return _per_role(s.dim_customer, "customer_key", lambda role: masks.mask_name(F.col("full_name"), role))


@query("mask_card", _role_sql("""CASE WHEN role = 'RETAIL_ADMIN' THEN card WHEN length(card) >= 4
  THEN repeat('*', length(card) - 4) || right(card, 4) ELSE '****' END""",
  "(SELECT customer_key, CASE WHEN customer_key % 8 = 0 THEN '12' ELSE '4000' || phone END AS card FROM dim_customer)"))
def _(s):
    card = F.when(F.col("customer_key") % 8 == 0, "12").otherwise(F.concat(F.lit("4000"), F.col("phone")))
    return _per_role(s.dim_customer, "customer_key", lambda role: masks.mask_card(card, role))


@query("mask_email_conditional", _role_sql(f"""CASE WHEN role = 'RETAIL_ADMIN' THEN email
  WHEN loyalty_tier = 'PLATINUM' THEN '****@****.***' ELSE {_TWO_SQL} END"""))
def _(s):
    segment = F.when(F.col("loyalty_tier") == "PLATINUM", masks.VIP).otherwise(F.col("customer_segment"))
    return _per_role(s.dim_customer, "customer_key",
                     lambda role: masks.mask_email_by_segment(F.col("email"), segment, role))


@query("mask_sha2", _role_sql("sha256(customer_id)"))
def _(s):
    return _per_role(s.dim_customer, "customer_key", lambda role: masks.mask_sha2(F.col("customer_id"), role))


# Row filters

@query("rls_region", star(f"""
, {_MAPPING_SQL}
SELECT 'U2' AS user_name, store_key, region FROM dim_store
  WHERE region = (SELECT region FROM mapping WHERE user_name = 'U2')
UNION ALL SELECT 'U1', store_key, region FROM dim_store
UNION ALL SELECT 'U6', store_key, region FROM dim_store"""))
def _(s):
    stores, out = s.dim_store.select("store_key", "region"), None
    for user in ("U2", "U1", "U6", "nobody"):
        seen = A.by_region_policy(stores, _mapping(s), "region", "RETAIL_ANALYST", user)
        seen = seen.select(F.lit(user).alias("user_name"), "store_key", "region")
        out = seen if out is None else out.unionByName(seen)
    return out


@query("rls_segment", star("""
SELECT customer_key, customer_segment FROM dim_customer WHERE customer_segment IN
  (SELECT DISTINCT c_mktsegment FROM customer WHERE c_custkey % 2 = 1 AND c_nationkey = 5 AND c_acctbal > 9000)"""))
def _(s):
    rich = s.table("customer").filter("c_custkey % 2 = 1 AND c_nationkey = 5 AND c_acctbal > 9000")
    mapping = rich.select(F.lit("DATA_ANALYST_01").alias("user_name"), F.col("c_mktsegment").alias("segment"))
    return A.by_segment_policy(s.dim_customer, mapping, "customer_segment", "RETAIL_ANALYST", "DATA_ANALYST_01").select(
        "customer_key", "customer_segment")


@query("or_exists_filter", star(f"""
, {_MAPPING_SQL}
SELECT store_key, region FROM dim_store WHERE region IN
  (SELECT region FROM mapping WHERE user_name IN ('U3', 'U10') OR access_level = 'NONE')"""))
def _(s):
    grants = _mapping(s).filter(F.col("user_name").isin("U3", "U10")).select(
        F.col("user_name"), F.lit("RETAIL_VIEWER").alias("role_name"), "region")
    return A.by_view_access(s.dim_store, grants, "region", "RETAIL_VIEWER", "U3").select("store_key", "region")


_GRANTS = "SELECT region FROM mapping WHERE user_name = 'U2'"


@query("secure_sales", star(f"""
, {_MAPPING_SQL}
SELECT order_id, order_line_id, full_date AS sale_date, month_name, year_number, full_name AS customer_name,
  customer_segment, loyalty_tier, product_name, category, brand, store_name, s.region, s.city, s.state, quantity,
  CAST(f.unit_price AS DOUBLE) AS unit_price, CAST(discount_percent AS DOUBLE) AS discount_percent,
  CAST(net_amount AS DOUBLE) AS net_amount, payment_method
FROM fact_sales f JOIN dim_date USING (date_key) JOIN dim_customer c USING (customer_key)
  JOIN dim_product p USING (product_key) JOIN dim_store s USING (store_key)
WHERE c.is_current AND s.region IN ({_GRANTS})"""))
def _(s):
    grants = _mapping(s).select("user_name", F.lit("none").alias("role_name"), "region")
    return S.secure_sales(s.fact_sales, s.dim_date, s.dim_customer, s.dim_product, s.dim_store, grants,
                          masks.ANALYST, "U2")


@query("secure_customer_360", star(f"""
SELECT c.customer_key, customer_id, left(full_name, 1) || '****' AS customer_name, {_TWO_SQL} AS email,
  customer_segment, loyalty_tier, city, state, region, registration_date, COUNT(DISTINCT order_id) AS total_orders,
  CAST(SUM(net_amount) AS DOUBLE) AS lifetime_value, {mean('net_amount')} AS avg_order_value,
  MIN(full_date) AS first_purchase_date, MAX(full_date) AS last_purchase_date,
  CAST(date_diff('day', MAX(full_date), DATE '2001-07-31') AS INTEGER) AS days_since_last_purchase
FROM dim_customer c LEFT JOIN fact_sales f ON c.customer_key = f.customer_key
  LEFT JOIN dim_date d ON d.date_key = f.date_key GROUP BY ALL"""))
def _(s):
    out = S.secure_customer_360(s.dim_customer, s.fact_sales, s.dim_date, s.as_of, masks.ANALYST)
    return out.withColumn("avg_order_value", F.round("avg_order_value", 2))


@query("secure_product_performance", star("""
SELECT product_id, product_name, category, subcategory, brand, CAST(p.unit_price AS DOUBLE) AS unit_price,
  CAST(NULL AS DOUBLE) AS unit_cost, CAST(NULL AS DOUBLE) AS profit_margin, COUNT(DISTINCT order_id) AS times_ordered,
  CAST(SUM(quantity) AS BIGINT) AS units_sold, CAST(SUM(net_amount) AS DOUBLE) AS total_revenue
FROM dim_product p LEFT JOIN fact_lines f ON p.product_key = f.product_key WHERE is_active GROUP BY ALL"""))
def _(s):
    return S.secure_product_performance(s.dim_product, s.fact_lines, masks.ANALYST)


@query("sales_by_region", star(f"""
, {_MAPPING_SQL}
SELECT order_id, order_line_id, product_key, f.store_key, date_key, customer_key, quantity,
  CAST(net_amount AS DOUBLE) AS net_amount, full_date, store_name, s.region
FROM fact_sales f JOIN dim_date USING (date_key) JOIN dim_store s ON s.store_key = f.store_key
WHERE s.region IN ({_GRANTS})"""))
def _(s):
    return S.sales_by_region(s.fact_sales, s.dim_date, s.dim_store, _mapping(s), "U2").select(
        "order_id", "order_line_id", "product_key", "store_key", "date_key", "customer_key", "quantity",
        "net_amount", "full_date", "store_name", "region")
