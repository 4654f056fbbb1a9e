"""Binds the given tables to the star schema.

``fact_lines`` holds what the line alone knows; ``fact_sales`` adds the order.
A mart that needs no order column starts from ``fact_lines`` and so saves the
line-order shuffle. No join here is hinted: a side is broadcast only when its
size statistics are under ``spark.sql.autoBroadcastJoinThreshold``, otherwise
Spark joins by shuffle and AQE splits skewed partitions.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions import bands
from martloom.functions import dates as D
from martloom.functions.hashing import record_hash
from martloom.operators import calendar
from martloom.schemas import TABLES

CALENDAR_START = dt.date(1995, 1, 1)
CALENDAR_DAYS = 2557
AS_OF = dt.date(2001, 7, 31)


def money(value: Column, precision: int = 12) -> Column:
    return value.cast(f"decimal({precision},2)")


def from_cents(cents: Column) -> Column:
    return (cents.cast("decimal(12,0)") * F.lit(Decimal("0.01"))).cast("decimal(12,2)")


class Star:
    """Lazy views of one data folder."""

    def __init__(self, spark: SparkSession, folder: str, as_of: dt.date = AS_OF):
        self.spark, self.folder, self.as_of = spark, folder, as_of

    def table(self, name: str) -> DataFrame:
        reader = self.spark.read
        if name in TABLES:
            reader = reader.schema(TABLES[name])
        return reader.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def dim_date(self) -> DataFrame:
        return calendar.dim_date(self.spark, CALENDAR_START, CALENDAR_DAYS, self.as_of)

    @cached_property
    def places(self) -> DataFrame:
        nation, region = self.table("nation"), self.table("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            "n_nationkey", F.col("n_name").alias("place"), F.col("r_name").alias("region")
        )

    @cached_property
    def fact_lines(self) -> DataFrame:
        cents = F.floor(F.col("l_extendedprice") * 100 + 0.5)
        percent = F.floor(F.col("l_discount") * 100 + 0.5)
        # Whole cents keep the row work in long arithmetic; half a cent rounds up.
        cut = F.floor((cents * percent + 50) / 100)
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("order_line_id"),
            F.col("l_partkey").alias("product_key"),
            F.col("l_suppkey").alias("store_key"),
            F.col("l_quantity").cast("int").alias("quantity"),
            from_cents(cents).alias("gross_amount"),
            percent.cast("decimal(5,2)").alias("discount_percent"),
            from_cents(cut).alias("discount_amount"),
            from_cents(cents - cut).alias("net_amount"),
            F.col("l_shipdate").alias("load_timestamp"),
        )

    @cached_property
    def order_heads(self) -> DataFrame:
        ordered = F.to_date("o_orderdate")
        return self.table("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_key"),
            F.col("o_orderdate").alias("transaction_timestamp"),
            D.date_key(ordered).alias("date_key"),
            F.col("o_orderpriority").alias("payment_method"),
            F.col("o_orderstatus").alias("order_status"),
        )

    def _with_orders(self, heads: DataFrame, how: str) -> DataFrame:
        unit = money(F.col("gross_amount") / F.nullif(F.col("quantity"), F.lit(0)), 10)
        return self.fact_lines.join(heads, "order_id", how).withColumn("unit_price", unit)

    @cached_property
    def fact_sales(self) -> DataFrame:
        """Every line; the order columns are NULL if the order is missing."""
        return self._with_orders(self.order_heads, "left")

    def fact_between(self, first: dt.date, after: dt.date) -> DataFrame:
        """Lines ordered in ``[first, after)``; the range reaches the scan of the orders."""
        stamp = F.col("transaction_timestamp")
        heads = self.order_heads.filter(
            (stamp >= F.lit(str(first)).cast("timestamp_ntz")) & (stamp < F.lit(str(after)).cast("timestamp_ntz"))
        )
        return self._with_orders(heads, "inner")

    @cached_property
    def dim_store(self) -> DataFrame:
        balance = F.col("s_acctbal")
        store_type = bands.at_least(balance, ((5000, "WAREHOUSE"), (0, "RETAIL")), "OUTLET")
        return (
            self.table("supplier").join(self.places, F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("s_suppkey").alias("store_key"),
                F.concat(F.lit("STORE-"), F.col("s_suppkey")).alias("store_id"),
                F.col("s_name").alias("store_name"),
                store_type.alias("store_type"),
                F.col("place").alias("city"),
                F.col("place").alias("state"),
                "region",
                F.floor(F.abs(balance)).cast("int").alias("square_footage"),
                F.date_add(D.day("1990-01-01"), (F.col("s_suppkey") % 1000).cast("int")).alias("open_date"),
                (balance > -500).alias("is_active"),
            )
        )

    @cached_property
    def dim_product(self) -> DataFrame:
        price = money(F.col("p_retailprice"), 10)
        cost = money(F.round(F.col("unit_price") * (50 + (F.col("p_size") % 10) * 6) / 100, 2), 10)
        margin = F.round((F.col("unit_price") - F.col("unit_cost")) / F.nullif(F.col("unit_price"), F.lit(0)) * 100, 2)
        return (
            self.table("part")
            .withColumn("unit_price", price)
            .withColumn("unit_cost", cost)
            .select(
                F.col("p_partkey").alias("product_key"),
                F.concat(F.lit("PROD-"), F.col("p_partkey")).alias("product_id"),
                F.col("p_name").alias("product_name"),
                F.col("p_type").alias("category"),
                F.concat(F.lit("SIZE-"), F.floor(F.col("p_size") / 10)).alias("subcategory"),
                F.col("p_brand").alias("brand"),
                "unit_price",
                "unit_cost",
                F.when(F.col("unit_price") > 0, margin).otherwise(0).cast("decimal(5,2)").alias("profit_margin"),
                (F.col("p_size") <= 45).alias("is_active"),
            )
        )

    @cached_property
    def dim_customer(self) -> DataFrame:
        """One current version per customer."""
        key = F.col("c_custkey")
        handle = F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit(".")))
        email = (
            F.when(key % 50 == 0, None)
            .when(key % 37 == 0, handle)
            .otherwise(F.concat(handle, F.lit("@example.com")))
        )
        points = F.floor(F.col("c_acctbal") * 5).cast("int")
        return (
            self.table("customer").join(self.places, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                key.alias("customer_key"),
                F.concat(F.lit("CUST-"), key).alias("customer_id"),
                F.col("c_name").alias("full_name"),
                email.alias("email"),
                F.concat(F.lit("555-"), F.lpad((key % 10000).cast("string"), 4, "0")).alias("phone"),
                F.date_add(D.day("1940-01-01"), ((key * 37) % 20000).cast("int")).alias("date_of_birth"),
                F.date_add(D.day("1994-01-01"), (key % 365).cast("int")).alias("registration_date"),
                F.col("c_mktsegment").alias("customer_segment"),
                points.alias("loyalty_points"),
                bands.loyalty_tier(points).alias("loyalty_tier"),
                F.col("place").alias("city"),
                F.col("place").alias("state"),
                "region",
                D.day("1994-01-01").alias("effective_date"),
                F.lit(None).cast("date").alias("end_date"),
                F.lit(True).alias("is_current"),
            )
        )

    @cached_property
    def customer_old(self) -> DataFrame:
        """Customer snapshot before the change: what staging held yesterday."""
        return self.table("customer").select(
            F.concat(F.lit("CUST-"), F.col("c_custkey")).alias("customer_id"),
            "c_custkey", "c_name", "c_nationkey",
            F.col("c_acctbal").cast("decimal(12,2)").alias("balance"),
            F.col("c_mktsegment").alias("segment"),
        )

    @cached_property
    def customer_new(self) -> DataFrame:
        """The snapshot after: a tenth change segment, some leave, some are new."""
        key = F.col("c_custkey")
        kept = (
            self.customer_old.filter(key % 97 != 0)
            .withColumn("segment", F.when(key % 10 == 0, F.concat(F.col("segment"), F.lit("_PLUS")))
                        .otherwise(F.col("segment")))
        )
        fresh = (
            self.customer_old.filter(key % 40 == 0)
            .withColumn("c_custkey", key + 1_000_000_000)
            .withColumn("customer_id", F.concat(F.lit("CUST-"), F.col("c_custkey")))
        )
        return kept.unionByName(fresh)

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")


def customer_hash() -> Column:
    return record_hash(["c_name", "c_nationkey", "balance", "segment"])
