"""Staging tables derived from the given ones, with some faults for the rules to find."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.plans.star import Star


def staged_sales(s: Star) -> DataFrame:
    """Sales as staged: some lines lack an order id, a quantity or a matching amount."""
    key = F.col("order_id") * 7 + F.col("order_line_id")
    methods = F.array(*[F.lit(m) for m in ("CREDIT_CARD", "DEBIT_CARD", "CASH", "PAYPAL", "CHEQUE")])
    return s.fact_lines.select(
        F.when(key % 101 != 0, F.concat(F.lit("ORD-"), F.col("order_id"))).alias("order_id"),
        "order_line_id", "product_key",
        F.when(key % 103 == 0, 0).when(key % 107 == 0, None).otherwise(F.col("quantity")).alias("quantity"),
        F.col("gross_amount").cast("decimal(10,2)").alias("unit_price"),
        "discount_percent",
        (F.col("net_amount") * F.col("quantity") + F.when(key % 109 == 0, 5).otherwise(0))
        .cast("decimal(12,2)").alias("total_amount"),
        F.get(methods, (key % 5).cast("int")).alias("payment_method"),
    ).withColumn("total_amount", F.when(F.col("quantity") == 0, F.lit(0)).otherwise(F.col("total_amount"))
                 .cast("decimal(12,2)"))


def staged_customers(s: Star) -> DataFrame:
    key = F.col("customer_key")
    return s.dim_customer.select(
        F.when(key % 89 != 0, F.col("customer_id")).alias("customer_id"), "email",
        F.date_add("registration_date", F.when(key % 83 == 0, 9000).otherwise(0)).alias("registration_date"))
