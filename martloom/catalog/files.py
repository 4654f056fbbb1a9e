"""Readers, loads and sinks, on files that Spark first writes from the given tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from martloom.catalog.oracle import star
from martloom.catalog.registry import query
from martloom.functions import variants
from martloom.operators.keys import pieces
from martloom.session import materialise, scratch_path
from martloom.sources import external, feed, files, loading, sinks

_NOW = dt.datetime(2001, 7, 31, 6)
_CUSTOMER = "c_custkey string, c_name string, c_nationkey string, c_acctbal string, c_mktsegment string"


def _written(s, df, label, fmt="csv", **options):
    path = scratch_path(s.spark, label)
    sinks.unload(df, path, fmt, **options)
    return path


# Delimited text

@query("read_csv_standard", """
SELECT c_custkey AS id, c_name || ', "x"' AS name,
  CASE c_custkey % 8 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN NULL WHEN 3 THEN NULL ELSE 'S ' || c_mktsegment END
    AS segment
FROM customer""")
def _(s):
    key = F.col("c_custkey")
    token = F.get(F.array(*[F.lit(t) for t in ("NULL", "N/A", "NA", "\\N")]), (key % 8).cast("int"))
    raw = s.table("customer").select(
        key.alias("id"), F.concat("c_name", F.lit(', "x"')).alias("name"),
        F.coalesce(token, F.concat(F.lit(" S "), "c_mktsegment", F.lit("  "))).alias("segment"))
    path = _written(s, raw, "csv", escape='"', ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false")
    back = files.read_delimited(s.spark, path, "id string, name string, segment string")
    return back.select(F.col("id").cast("bigint").alias("id"), "name", "segment")


@query("read_csv_no_header", "SELECT CAST(s_suppkey AS VARCHAR) AS a, s_name AS b FROM supplier")
def _(s):
    path = _written(s, s.table("supplier").select("s_suppkey", "s_name"), "csv-bare", header=False)
    return files.read_delimited(s.spark, path, "a string, b string", files.CSV_NO_HEADER).select("a", "b")


@query("read_csv_pipe", "SELECT p_partkey AS id, p_name AS name, p_brand AS brand FROM part")
def _(s):
    raw = s.table("part").select("p_partkey", "p_name", "p_brand")
    path = _written(s, raw, "csv-pipe", sep="|")
    back = files.read_delimited(s.spark, path, "id string, name string, brand string", files.CSV_PIPE)
    return back.select(F.col("id").cast("bigint").alias("id"), "name", "brand")


@query("read_tsv", "SELECT o_orderkey AS id, o_orderpriority AS priority FROM orders")
def _(s):
    path = _written(s, s.table("orders").select("o_orderkey", "o_orderpriority"), "tsv", sep="\t")
    back = files.read_delimited(s.spark, path, "id string, priority string", files.TSV)
    return back.select(F.col("id").cast("bigint").alias("id"), "priority")


@query("unload", "SELECT o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS day FROM orders")
def _(s):
    raw = s.table("orders").select("o_orderkey", "o_orderstatus", F.to_date("o_orderdate").alias("day"))
    path = scratch_path(s.spark, "unload")
    for _again in range(2):
        sinks.unload(raw, path, "csv", overwrite=True, header=True)
    return s.spark.read.schema("o_orderkey bigint, o_orderstatus string, day date").csv(path, header=True)


# Documents

def _event_json(s):
    return F.to_json(F.struct("event_id", "event_type", "ts", "props"))


@query("read_json_lines", """
SELECT event_id, event_type, event_id % 200 = 3 AS broken FROM events""")
def _(s):
    broken = F.col("event_id") % 200 == 3
    text = F.when(broken, F.concat(F.lit('{"event_id": '), F.col("event_id"), F.lit(', "event_type": "'),
                                   F.col("event_type"))).otherwise(_event_json(s))
    path = _written(s, s.events.select(text.alias("value")), "ndjson", "text")
    docs = files.read_json_lines(s.spark, path)
    doc, raw = F.col("raw_json"), F.col("raw_text")
    key = F.regexp_extract(raw, r'"event_id": ?(\d+)', 1).cast("bigint")
    kind = F.regexp_extract(raw, r'"event_type": ?"(\w+)', 1)
    return docs.select(F.coalesce(variants.path(doc, "event_id", "bigint"), key).alias("event_id"),
                       F.coalesce(variants.path(doc, "event_type"), kind).alias("event_type"),
                       doc.isNull().alias("broken"))


@query("read_json_array", "SELECT event_id, event_type FROM events")
def _(s):
    # Arrays of at most 5000 events, one file each.
    chunk = F.floor(F.col("event_id") / 5000)
    arrays = s.events.groupBy(chunk.alias("chunk")).agg(
        F.to_json(F.collect_list(F.struct("event_id", "event_type"))).alias("value"))
    path = scratch_path(s.spark, "json-array")
    arrays.repartition("chunk").write.partitionBy("chunk").text(path)
    return files.read_json_array(s.spark, f"{path}/chunk=*", "event_id bigint, event_type string").select(
        "event_id", "event_type")


@query("read_json_strict", "SELECT event_id, event_type FROM events")
def _(s):
    path = _written(s, s.events.select(_event_json(s).alias("value")), "ndjson-strict", "text")
    docs = files.read_json_strict(s.spark, path)
    return docs.select(variants.path(F.col("raw_json"), "event_id", "bigint").alias("event_id"),
                       variants.path(F.col("raw_json"), "event_type").alias("event_type"))


@query("match_by_name", "SELECT event_id, event_type, value AS order_value FROM events")
def _(s):
    raw = s.events.select(F.to_json(F.struct(
        F.col("event_id").alias("EVENT_ID"), F.col("event_type").alias("Event_Type"),
        F.col("value").alias("Order_VALUE"), F.lit(1).alias("other"))).alias("value"))
    path = _written(s, raw, "json-by-name", "text")
    return files.match_by_name(s.spark, path, "event_id bigint, event_type string, order_value double")


# Column formats

@query("read_parquet", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_totalprice > 200000")
def _(s):
    orders = files.read_parquet(s.spark, f"{s.folder}/orders.parquet")
    return orders.filter("o_totalprice > 200000").select("o_orderkey", "o_custkey", "o_orderstatus")


@query("read_orc", "SELECT s_suppkey, s_name FROM supplier")
def _(s):
    raw = s.table("supplier").select("s_suppkey", F.concat(F.lit("  "), "s_name", F.lit(" ")).alias("s_name"))
    return files.read_orc(s.spark, _written(s, raw, "orc", "orc"))


@query("read_xml", "SELECT s_suppkey AS id, s_name AS name FROM supplier")
def _(s):
    raw = s.table("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    path = _written(s, raw, "xml", "xml", rowTag="store", rootTag="stores")
    return files.read_xml(s.spark, path, "store", "id bigint, name string")


@query("file_metadata", """
SELECT COUNT(*) AS row_count, COUNT(*) AS distinct_places, TRUE AS dense, TRUE AS named FROM lineitem""")
def _(s):
    raw = s.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey").repartition(3)
    path = _written(s, raw, "csv-meta")
    rows = files.read_delimited(s.spark, path, "a string, b string, c string", load_time=_NOW)
    per_file = rows.groupBy("_source_file").agg(
        F.count("*").alias("n"), F.countDistinct("_file_row_number").alias("places"),
        F.min("_file_row_number").alias("lo"), F.max("_file_row_number").alias("hi"),
        F.count("_file_last_modified").alias("timed"))
    return per_file.agg(
        F.sum("n").alias("row_count"), F.sum("places").alias("distinct_places"),
        F.min((F.col("lo") == 1) & (F.col("hi") == F.col("n"))).alias("dense"),
        F.min((F.col("timed") == F.col("n")) & F.col("_source_file").endswith(".csv")).alias("named"))


# External tables

def _raw_sales(s, faults=True):
    """Sales lines as raw text; with faults, some numbers and dates cannot be read."""
    key = F.col("order_id") * 7 + F.col("order_line_id")
    bad = F.lit(faults)
    return s.fact_sales.select(
        F.concat(F.lit("ORD-"), "order_id").alias("order_id"),
        F.col("order_line_id").cast("string").alias("order_line_id"),
        F.concat(F.lit("CUST-"), "customer_key").alias("customer_id"),
        F.concat(F.lit("PROD-"), "product_key").alias("product_id"),
        F.concat(F.lit("STORE-"), "store_key").alias("store_id"),
        F.when(bad & (key % 113 == 0), "soon").otherwise(
            F.date_format("transaction_timestamp", "yyyy-MM-dd HH:mm:ss")).alias("transaction_date"),
        F.when(bad & (key % 127 == 0), "many").otherwise(F.col("quantity").cast("string")).alias("quantity"),
        F.col("unit_price").cast("string").alias("unit_price"),
        F.col("discount_percent").cast("string").alias("discount_percent"),
        F.col("net_amount").cast("string").alias("total_amount"),
        F.concat(F.lit(" "), F.lower("payment_method")).alias("payment_method"),
        F.when(key % 5 == 0, "NULL").otherwise(F.lower("order_status")).alias("order_status"))


_RAW_ORACLE = """, raw AS (
  SELECT 'ORD-' || order_id AS order_id, order_line_id, 'CUST-' || customer_key AS customer_id,
    'PROD-' || product_key AS product_id, 'STORE-' || store_key AS store_id,
    CASE WHEN k % 113 <> 0 THEN transaction_timestamp END AS transaction_date,
    CASE WHEN k % 127 <> 0 THEN quantity END AS quantity, CAST(unit_price AS DOUBLE) AS unit_price,
    CAST(discount_percent AS DOUBLE) AS discount_percent, CAST(net_amount AS DOUBLE) AS total_amount,
    upper(payment_method) AS payment_method, CASE WHEN k % 5 <> 0 THEN order_status END AS order_status,
    k % 113 = 0 OR k % 127 = 0 AS bad, k
  FROM (SELECT *, order_id * 7 + order_line_id AS k FROM fact_sales)
)
"""
_SALES_COLUMNS = ["order_id", "order_line_id", "customer_id", "product_id", "store_id", "transaction_date", "quantity",
                  "unit_price", "discount_percent", "total_amount", "payment_method", "order_status"]
_SALES_SELECT = ", ".join(_SALES_COLUMNS)


def _external_sales(s):
    path = scratch_path(s.spark, "ext-sales")
    day = F.col("transaction_timestamp")
    keyed = s.fact_sales.select("order_id", "order_line_id", "net_amount", "quantity", "unit_price",
                                "discount_percent", "customer_key", "product_key", "store_key", day)
    raw = keyed.select(
        F.col("order_id").cast("string").alias("order_id"), "order_line_id",
        F.concat(F.lit("CUST-"), "customer_key").alias("customer_id"),
        F.concat(F.lit("PROD-"), "product_key").alias("product_id"),
        F.concat(F.lit("STORE-"), "store_key").alias("store_id"),
        F.date_format(day, "yyyy-MM-dd HH:mm:ss").alias("transaction_date"), "quantity", "unit_price",
        "discount_percent", F.col("net_amount").alias("total_amount"), F.lit("CASH").alias("payment_method"),
        F.lit("COMPLETED").alias("order_status"), F.year(day).alias("year"), F.month(day).alias("month"))
    raw.repartition("year", "month").write.partitionBy("year", "month").csv(path, header=True)
    return external.sales(s.spark, path)


@query("ext_sales", star("""
SELECT CAST(order_id AS VARCHAR) AS order_id, order_line_id, quantity, CAST(net_amount AS DOUBLE) AS total_amount,
  transaction_timestamp AS transaction_date, CAST(year(transaction_timestamp) AS INTEGER) AS partition_year,
  CAST(month(transaction_timestamp) AS INTEGER) AS partition_month FROM fact_sales"""))
def _(s):
    return _external_sales(s).select("order_id", "order_line_id", "quantity", "total_amount", "transaction_date",
                                     "partition_year", "partition_month")


@query("partition_prune_agg", star("""
SELECT CAST(month(transaction_timestamp) AS INTEGER) AS partition_month, COUNT(*) AS order_count,
  CAST(SUM(net_amount) AS DOUBLE) AS total_revenue
FROM fact_sales WHERE year(transaction_timestamp) = 2000 GROUP BY 1"""))
def _(s):
    return external.monthly_totals(_external_sales(s), 2000)


def _product_docs(s):
    doc = F.struct("product_id", "product_name", "category", "brand",
                   F.col("unit_price").cast("double").alias("unit_price"),
                   F.col("unit_cost").cast("double").alias("unit_cost"), "is_active",
                   F.date_format(F.date_add(F.lit("2000-01-01").cast("date"), (F.col("product_key") % 500).cast("int")),
                                 "yyyy-MM-dd").alias("launch_date"),
                   F.struct(F.col("subcategory").alias("size"), (F.col("product_key") % 7).alias("grade"))
                   .alias("attributes"))
    return s.dim_product.select(F.to_json(doc).alias("value"))


_PRODUCT_DOCS = """
SELECT product_id, product_name, category, brand, CAST(unit_price AS DOUBLE) AS unit_price, is_active,
  CAST(DATE '2000-01-01' + CAST(product_key % 500 AS INTEGER) AS DATE) AS launch_date,
  '{"grade":' || product_key % 7 || ',"size":"' || subcategory || '"}' AS attributes FROM dim_product"""
_PRODUCT_COLUMNS = ["product_id", "product_name", "category", "brand", "unit_price", "is_active", "launch_date",
                    "attributes"]


@query("ext_products", star(_PRODUCT_DOCS))
def _(s):
    path = _written(s, _product_docs(s), "ext-products", "text")
    return external.products(s.spark, path).select(*_PRODUCT_COLUMNS)


@query("copy_products", star(_PRODUCT_DOCS))
def _(s):
    path = _written(s, _product_docs(s), "copy-products", "text")
    good, _bad = loading.apply_on_error(loading.clean_products(files.read_json_lines(s.spark, path)))
    return good.select(*_PRODUCT_COLUMNS)


def _customer_text(s):
    """Customers as the raw text columns, padded and in odd case."""
    key = F.col("customer_key")
    return s.dim_customer.select(
        "customer_id", F.concat(F.lit(" "), F.lower(F.split_part("full_name", F.lit("#"), F.lit(1)))).alias("first_name"),
        F.concat(F.lit("N"), key).alias("last_name"), F.upper("email").alias("email"), "phone",
        F.when(key % 19 == 0, "unknown").otherwise(F.date_format("date_of_birth", "yyyy-MM-dd")).alias("date_of_birth"),
        F.lit("f").alias("gender"), F.date_format("registration_date", "yyyy-MM-dd").alias("registration_date"),
        F.lower("customer_segment").alias("customer_segment"), F.lit("1 Main St").alias("address_line1"),
        F.lower("city").alias("city"), F.lower("state").alias("state"), F.lit("00100").alias("postal_code"),
        F.lit("usa").alias("country"), F.concat(F.col("loyalty_points").cast("string"), F.lit(".5")).alias(
            "loyalty_points"),
        F.lit("email").alias("preferred_contact"), F.when(key % 2 == 0, "yes").otherwise("no").alias("is_active"))


@query("ext_customers", star("""
SELECT customer_id, 'N' || customer_key AS last_name, date_of_birth, registration_date, loyalty_points,
  customer_key % 2 = 0 AS is_active FROM dim_customer"""))
def _(s):
    typed = _customer_text(s).join(
        s.dim_customer.select("customer_id", F.col("date_of_birth").alias("born"), F.col("loyalty_points").alias("p")),
        "customer_id").withColumns({"date_of_birth": F.col("born"), "loyalty_points": F.col("p"),
                                    "is_active": F.col("is_active") == "yes"}).drop("born", "p")
    path = _written(s, typed, "ext-customers", "parquet")
    return external.customers(s.spark, path).select("customer_id", "last_name", "date_of_birth", "registration_date",
                                                    "loyalty_points", "is_active")


@query("copy_customers", star("""
SELECT customer_id, 'Customer' AS first_name, email, CASE WHEN customer_key % 19 <> 0 THEN date_of_birth END
    AS date_of_birth, upper(customer_segment) AS customer_segment, 'Nation' || lower(substring(city, 7)) AS city,
  upper(state) AS state, 'USA' AS country,
  CAST(loyalty_points + CASE WHEN loyalty_points < 0 THEN -1 ELSE 1 END AS INTEGER) AS loyalty_points,
  customer_key % 2 = 0 AS is_active,
  md5(concat_ws('|', 'customer', 'N' || customer_key, COALESCE(upper(email), ''), phone, lower(customer_segment),
    '1 Main St', lower(city), lower(state), '00100', loyalty_points || '.5')) AS record_hash
FROM dim_customer"""))
def _(s):
    from martloom.schemas import RAW_CUSTOMERS

    path = _written(s, _customer_text(s), "copy-customers")
    raw = files.read_delimited(s.spark, path, RAW_CUSTOMERS)
    return loading.clean_customers(raw).select(
        "customer_id", "first_name", "email", "date_of_birth", "customer_segment", "city", "state", "country",
        "loyalty_points", "is_active", "record_hash")


def _click_docs(s):
    odd = F.col("event_id") % 60 == 11
    doc = F.struct(
        F.concat(F.lit("evt-"), "event_id").alias("event_id"), F.concat(F.lit("S"), "user_id").alias("session_id"),
        F.when(F.col("event_id") % 10 != 0, F.concat(F.lit("CUST-"), "user_id")).alias("customer_id"),
        F.when(odd, "later").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")).alias("event_timestamp"),
        F.col("event_type").alias("event_type"), F.lit("Mobile").alias("device_type"),
        F.col("value").alias("order_value"))
    return s.events.select(F.to_json(doc).alias("value"))


_CLICK_ORACLE = """
SELECT 'evt-' || event_id AS event_id, 'S' || user_id AS session_id,
  CASE WHEN event_id % 10 <> 0 THEN 'CUST-' || user_id END AS customer_id, {kind} AS event_type,
  CASE WHEN event_id % 60 <> 11 THEN date_trunc('millisecond', ts) END AS event_timestamp{extra} FROM events"""


@query("ext_clickstream", _CLICK_ORACLE.format(
    kind="event_type", extra=", CASE WHEN event_id % 60 <> 11 THEN CAST(ts AS DATE) END AS event_date"))
def _(s):
    path = _written(s, _click_docs(s), "ext-clicks", "text")
    return external.clickstream(s.spark, path).select(
        "event_id", "session_id", "customer_id", "event_type", "event_timestamp", "event_date")


@query("copy_clickstream", _CLICK_ORACLE.format(
    kind="upper(event_type)", extra=", 'mobile' AS device_type, event_id % 60 = 11 AS missed"))
def _(s):
    path = _written(s, _click_docs(s), "copy-clicks", "text")
    marked = loading.clean_clickstream(files.read_json_lines(s.spark, path))
    return marked.select("event_id", "session_id", "customer_id", "event_type", "event_timestamp", "device_type",
                         (F.size(loading.MISSED) > 0).alias("missed"))


# Loads

def _marked_sales(s, files_out=4):
    from martloom.schemas import RAW_SALES

    raw = _raw_sales(s)
    raw = raw.repartitionByRange(pieces(raw, files_out), "order_id", "order_line_id", "product_id")
    path = _written(s, raw, "copy-sales")
    return loading.clean_sales(files.read_delimited(s.spark, path, RAW_SALES, load_time=_NOW))


@query("copy_sales", star(_RAW_ORACLE + f"SELECT {_SALES_SELECT} FROM raw"))
def _(s):
    return _marked_sales(s).select(*_SALES_COLUMNS)


# Of every how many products of a file one has a cost that cannot be read.
_FAULTY = {0: None, 1: 50, 2: 10, 3: 2}
_FAULTY_ORACLE = """, faulty AS (
  SELECT product_id, product_name, product_key % 4 AS file, CAST(unit_price AS DOUBLE) AS unit_price,
    CASE product_key % 4 WHEN 1 THEN product_key // 4 % 50 = 0 WHEN 2 THEN product_key // 4 % 10 = 0
      WHEN 3 THEN product_key // 4 % 2 = 0 ELSE FALSE END AS bad
  FROM dim_product), per_file AS (
  SELECT file, COUNT(*) AS n, COUNT(*) FILTER (bad) AS bad_rows FROM faulty GROUP BY file)
"""


def _marked_products(s):
    """Product documents in four files, with no, few, some and many costs that cannot be read."""
    key, paths = F.col("product_key"), []
    for file, every in _FAULTY.items():
        cost = F.col("unit_cost").cast("string")
        if every:
            cost = F.when(F.floor(key / 4) % every == 0, "unknown").otherwise(cost)
        doc = F.to_json(F.struct("product_id", "product_name", F.col("unit_price").cast("double").alias("unit_price"),
                                 cost.alias("unit_cost")))
        rows = s.dim_product.filter(key % 4 == file).select(doc.alias("value")).coalesce(1)
        paths.append(_written(s, rows, f"faulty-{file}", "text"))
    return loading.clean_products(files.read_json_lines(s.spark, paths))


def _by_policy(policy, loads):
    @query(f"on_error_{policy.lower().replace('%', '_percent')}", star(_FAULTY_ORACLE + f"""
SELECT product_id, product_name, unit_price FROM faulty JOIN per_file USING (file) WHERE NOT bad AND {loads}"""))
    def _(s):
        good, _bad = loading.apply_on_error(_marked_products(s), policy)
        return good.select("product_id", "product_name", F.col("unit_price").cast("double").alias("unit_price"))


_by_policy("CONTINUE", "TRUE")
_by_policy("SKIP_FILE", "bad_rows = 0")
_by_policy("SKIP_FILE_5", "bad_rows < 5")
_by_policy("SKIP_FILE_20%", "bad_rows * 100 < 20 * n")


@query("on_error_abort", star(_FAULTY_ORACLE + """
SELECT file, bad_rows > 0 AS aborted, CASE WHEN bad_rows > 0 THEN 0 ELSE n END AS loaded FROM per_file"""))
def _(s):
    """Each of the few files is a load of its own; the operator raises on the first bad row."""
    marked = materialise(_marked_products(s), "abort")
    rows = []
    for (name,) in sorted(marked.select("source_file").distinct().collect()):
        try:
            good, _bad = loading.apply_on_error(marked.filter(F.col("source_file") == name), "ABORT_STATEMENT")
            rows.append((name, False, good.count()))
        except ValueError as error:
            if not str(error).startswith("load aborted"):
                raise
            rows.append((name, True, 0))
    found = s.spark.createDataFrame(rows, "name string, aborted boolean, loaded bigint")
    return found.select(F.regexp_extract("name", "faulty-([0-9])", 1).cast("bigint").alias("file"), "aborted", "loaded")


@query("reject_rows", star(_FAULTY_ORACLE + """
SELECT product_id, 'cannot read unit_cost' AS rejection_reason, TRUE AS placed FROM faulty WHERE bad"""))
def _(s):
    _good, bad = loading.apply_on_error(_marked_products(s))
    return bad.select("product_id", "rejection_reason",
                      (F.col("source_file").isNotNull() & (F.col("file_row_number") > 0)).alias("placed"))


@query("validation_mode", star(_FAULTY_ORACLE + "SELECT product_id FROM faulty WHERE bad"))
def _(s):
    return loading.validate(_marked_products(s), "RETURN_ALL_ERRORS").select("product_id")


@query("load_history", star(_FAULTY_ORACLE + """
SELECT file, CASE WHEN bad_rows < 5 THEN n - bad_rows ELSE 0 END AS row_count, n AS row_parsed,
  bad_rows AS error_count, CASE WHEN bad_rows = 0 THEN 'LOADED' WHEN bad_rows >= 5 THEN 'LOAD_SKIPPED'
    ELSE 'PARTIALLY_LOADED' END AS status FROM per_file"""))
def _(s):
    history = loading.load_history(_marked_products(s), _NOW, "SKIP_FILE_5")
    return history.select(F.regexp_extract("file_name", "faulty-([0-9])", 1).cast("bigint").alias("file"), "row_count",
                          "row_parsed", "error_count", "status")


@query("missed_fields", star(_RAW_ORACLE + """
SELECT field, COUNT(*) AS rows FROM (
  SELECT 'transaction_date' AS field FROM raw WHERE k % 113 = 0 UNION ALL
  SELECT 'quantity' FROM raw WHERE k % 127 = 0) GROUP BY field"""))
def _(s):
    return loading.missed_fields(_marked_sales(s)).groupBy("field").agg(F.count("*").alias("rows"))


@query("incremental_load", star("""
SELECT 'orders' AS source, COUNT(*) AS loaded_first, CAST(0 AS BIGINT) AS loaded_again, COUNT(*) AS in_target
FROM orders"""))
def _(s):
    from martloom.schemas import RAW_SALES

    text = s.table("orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"), *[
            F.lit(None).cast("string").alias(c.split()[0]) for c in RAW_SALES.split(", ")[1:]])
    source = _written(s, text, "incremental-in")
    target, registry = scratch_path(s.spark, "incremental-out"), scratch_path(s.spark, "registry")

    def read(spark, paths):
        return files.read_delimited(spark, paths, RAW_SALES, load_time=_NOW)

    loaded = [loading.incremental_load(s.spark, source, target, registry, read, loading.clean_sales, batch, _NOW,
                                       glob="*.csv") for batch in ("b1", "b2")]
    stored = s.spark.read.parquet(target).agg(F.count("*").alias("in_target"))
    return stored.select(F.lit("orders").alias("source"), F.lit(loaded[0]).cast("bigint").alias("loaded_first"),
                         F.lit(loaded[1]).cast("bigint").alias("loaded_again"), "in_target")


@query("load_audit", """
SELECT 'b1' AS batch_id, 'ORDERS' AS table_name, COUNT(*) AS rows_loaded, CAST(0 AS BIGINT) AS rows_rejected,
  'COMPLETED' AS status, CAST(NULL AS VARCHAR) AS error_message FROM orders
UNION ALL SELECT 'b2', 'ORDERS', NULL, NULL, 'FAILED', 'disk gone'""")
def _(s):
    audit, target = scratch_path(s.spark, "audit"), scratch_path(s.spark, "audited")

    def load():
        s.table("orders").select("o_orderkey").write.parquet(target)
        return s.spark.read.parquet(target).count(), 0

    def fail():
        raise OSError("disk gone")

    for batch, job in (("b1", load), ("b2", fail)):
        loading.run_with_audit(s.spark, audit, "ORDERS", job, batch, lambda: _NOW)
    return loading.read_audit(s.spark, audit).select(
        "batch_id", "table_name", "rows_loaded", "rows_rejected", "status", "error_message")


@query("stage_files", "SELECT COUNT(*) > 0 AS found, TRUE AS sized FROM customer")
def _(s):
    path = _written(s, s.table("customer"), "stage-list")
    found = files.list_files(s.spark, path, since=dt.datetime(2000, 1, 1), glob="*.csv")
    return found.agg((F.count("*") > 0).alias("found"), F.min(F.col("length") > 0).alias("sized"))


@query("stage_preview", "SELECT CAST(s_suppkey AS VARCHAR) AS id, s_suppkey + 2 AS row_number FROM supplier "
                        "WHERE s_suppkey < 9 UNION ALL SELECT 's_suppkey', 1")
def _(s):
    ordered = s.table("supplier").select("s_suppkey", "s_name").repartitionByRange(1, "s_suppkey").sortWithinPartitions(
        "s_suppkey")
    rows = files.preview(s.spark, _written(s, ordered, "stage-preview"), 10)
    return rows.select(F.col("fields")[0].alias("id"), F.col("_file_row_number").alias("row_number"))


@query("seed_stores", """
SELECT 'STORE-00' || i AS store_id, COUNT(s_suppkey) AS suppliers
FROM range(1, 6) t(i) LEFT JOIN supplier ON s_suppkey % 5 + 1 = i GROUP BY 1""")
def _(s):
    hosts = s.table("supplier").groupBy(
        F.concat(F.lit("STORE-00"), F.col("s_suppkey") % 5 + 1).alias("store_id")).agg(F.count("*").alias("suppliers"))
    return loading.seed_stores(s.spark).select("store_id").join(hosts, "store_id", "left").fillna(0, ["suppliers"])


@query("load_feed", """
WITH t AS (SELECT p_partkey AS k, ROW_NUMBER() OVER (PARTITION BY p_partkey % 3 ORDER BY p_partkey) AS line FROM part)
SELECT 'PROD-' || k AS product_id, k % 3 AS file, k % 100 = 0 AS rejected, CASE WHEN k % 100 = 0 THEN line END AS line FROM t""")
def _(s):
    """Three files, two at first, in batches of about one file; a second start on the same checkpoint finds the third."""
    root, k = scratch_path(s.spark, "feed"), F.col("p_partkey")
    texts = s.table("part").select(k, F.to_json(F.struct(
        F.concat(F.lit("PROD-"), k).alias("product_id"), F.col("p_name").alias("product_name"),
        F.when(k % 100 == 0, F.lit("oops")).otherwise(F.col("p_retailprice").cast("string")).alias("unit_cost"))).alias("value"))
    for wanted in ((0, 1), (2,)):
        for file in wanted:
            part = texts.filter(k % 3 == file).coalesce(1).sortWithinPartitions("p_partkey")
            part.select("value").write.text(f"{root}/in/file-{file}")
        stream = feed.json_lines(s.spark, f"{root}/in/*", most_bytes=1)
        feed.load(stream, f"{root}/out", f"{root}/checkpoint", loading.clean_products, lambda: _NOW).awaitTermination()
    file = F.regexp_extract("source_file", "file-([0-9])", 1).cast("bigint").alias("file")
    good = s.spark.read.parquet(f"{root}/out").select(
        "product_id", file, F.lit(False).alias("rejected"), F.lit(None).cast("bigint").alias("line"))
    bad = s.spark.read.parquet(f"{root}/out_rejected").select("product_id", file, F.lit(True).alias("rejected"), F.col("file_row_number").alias("line"))
    return good.unionByName(bad)
