"""Schema-on-read tables over files."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions import casts
from martloom.functions.variants import path as at
from martloom.schemas import RAW_SALES
from martloom.sources import files

# Document fields and their types.
PRODUCT_FIELDS = {
    "product_id": "string", "product_name": "string", "category": "string", "subcategory": "string",
    "brand": "string", "unit_cost": "double", "unit_price": "double", "weight_kg": "double", "is_active": "boolean",
}
CLICK_FIELDS = {
    "event_id": "string", "customer_id": "string", "session_id": "string", "event_type": "string",
    "page_url": "string", "referrer_url": "string", "device_type": "string", "browser": "string", "os": "string",
    "ip_address": "string", "duration_seconds": "int", "scroll_depth_percent": "int", "product_id": "string",
    "quantity": "int", "order_id": "string", "order_value": "double", "search_query": "string",
    "cart_value": "double",
}
CUSTOMER_TYPES = {
    "customer_id": "string", "first_name": "string", "last_name": "string", "email": "string", "phone": "string",
    "date_of_birth": "date", "gender": "string", "registration_date": "date", "customer_segment": "string",
    "address_line1": "string", "city": "string", "state": "string", "postal_code": "string", "country": "string",
    "loyalty_points": "int", "preferred_contact": "string", "is_active": "boolean",
}


def sales(spark: SparkSession, path: str) -> DataFrame:
    """CSV under ``year=/month=`` folders. A filter on the folder columns prunes the files."""
    schema = RAW_SALES + ", year int, month int"
    raw = spark.read.schema(schema).option("header", "true").csv(path)
    number = {"order_line_id": "int", "quantity": "int", "unit_price": "double", "discount_percent": "double",
              "total_amount": "double"}
    tagged = files.with_source(raw)
    return tagged.select(
        *[F.col(c).try_cast(number[c]).alias(c) if c in number
          else casts.try_timestamp(F.col(c)).alias(c) if c == "transaction_date" else F.col(c)
          for c in raw.columns if c not in ("year", "month")],
        F.col("year").alias("partition_year"), F.col("month").alias("partition_month"),
        F.col("_source_file").alias("source_file"), F.col("_file_last_modified").alias("file_last_modified"))


def products(spark: SparkSession, path: str) -> DataFrame:
    docs = files.read_json_lines(spark, path).filter(F.col("raw_json").isNotNull())
    doc = F.col("raw_json")
    return docs.select(
        *[at(doc, name, kind).alias(name) for name, kind in PRODUCT_FIELDS.items()],
        casts.try_date(at(doc, "launch_date")).alias("launch_date"),
        F.try_variant_get(doc, "$.attributes", "variant").alias("attributes"),
        F.col("_source_file").alias("source_file"), F.col("_file_row_number").alias("file_row_number"))


def customers(spark: SparkSession, path: str) -> DataFrame:
    rows = files.with_source(spark.read.parquet(path))
    return rows.select(
        *[F.col(name).cast(kind).alias(name) for name, kind in CUSTOMER_TYPES.items()],
        F.col("_source_file").alias("source_file"))


def clickstream(spark: SparkSession, path: str) -> DataFrame:
    docs = files.read_json_lines(spark, path, numbered=False).filter(F.col("raw_json").isNotNull())
    doc = F.col("raw_json")
    stamp = casts.try_timestamp(at(doc, "event_timestamp"))
    return docs.select(
        *[at(doc, name, kind).alias(name) for name, kind in CLICK_FIELDS.items()],
        stamp.alias("event_timestamp"), F.to_date(stamp).alias("event_date"),
        F.col("_source_file").alias("source_file"))


def monthly_totals(table: DataFrame, year: int) -> DataFrame:
    """Rows and revenue per month of one year; only that year's folders are read."""
    return table.filter(F.col("partition_year") == year).groupBy("partition_month").agg(
        F.count("*").alias("order_count"), F.sum(F.col("total_amount").cast("decimal(12,2)")).alias("total_revenue"))


def sales_with_names(table: DataFrame, customer: DataFrame, product: DataFrame, year: int, month: int) -> DataFrame:
    """One month of sales joined to customer and product names."""
    part = table.filter((F.col("partition_year") == year) & (F.col("partition_month") == month))
    return part.join(customer.select("customer_id", "first_name", "last_name"), "customer_id", "left").join(
        product.select("product_id", "product_name"), "product_id", "left").select(
        "order_id", "first_name", "last_name", "product_name", "total_amount")


def hours_ago(now: dt.datetime, hours: int) -> dt.datetime:
    return now - dt.timedelta(hours=hours)
