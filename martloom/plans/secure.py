"""Filtered and masked extracts of the star."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions import masks
from martloom.functions.tables import can_access_region
from martloom.operators import access as A
from martloom.operators.keys import small_side
from martloom.plans import marts as M


def secure_sales(fact: DataFrame, calendar: DataFrame, customer: DataFrame, product: DataFrame, store: DataFrame,
                 grants: DataFrame, role: str, user: str) -> DataFrame:
    """Star rows the reader may see. Stores are filtered before the fact is joined.

    Only current customer versions join, so lines of expired versions are left out.
    """
    seen = A.by_view_access(store.select("store_key", "store_name", "region", "city", "state"), grants, "region",
                            role, user)
    people = customer.filter("is_current").select(
        "customer_key", F.col("full_name").alias("customer_name"), "customer_segment", "loyalty_tier")
    goods = product.select("product_key", "product_name", "category", "brand")
    days = calendar.select("date_key", F.col("full_date").alias("sale_date"), "month_name", "year_number")
    joined = (
        fact.join(small_side(seen), "store_key").join(days, "date_key")
        .join(small_side(people), "customer_key").join(small_side(goods), "product_key")
    )
    return joined.select(
        "order_id", "order_line_id", "sale_date", "month_name", "year_number", "customer_name", "customer_segment",
        "loyalty_tier", "product_name", "category", "brand", "store_name", "region", "city", "state", "quantity",
        "unit_price", "discount_percent", "net_amount", "payment_method",
    )


def secure_customer_360(customer: DataFrame, fact: DataFrame, calendar: DataFrame, as_of: dt.date,
                        role: str) -> DataFrame:
    """Names and addresses are masked after the aggregation."""
    return M.customer_360(customer, fact, calendar, as_of).select(
        "customer_key", "customer_id",
        masks.initial_only(F.col("full_name"), role).alias("customer_name"),
        masks.email_for_reader(F.col("email"), role).alias("email"),
        "customer_segment", "loyalty_tier", "city", "state", "region", "registration_date",
        "total_orders", "lifetime_value", "avg_order_value", "first_purchase_date", "last_purchase_date",
        "days_since_last_purchase",
    )


def secure_product_performance(product: DataFrame, fact: DataFrame, role: str) -> DataFrame:
    """Cost and margin only for privileged roles."""
    sales = fact.groupBy("product_key").agg(
        F.countDistinct("order_id").alias("times_ordered"),
        F.sum("quantity").alias("units_sold"),
        F.sum("net_amount").alias("total_revenue"),
    )
    hide = role not in masks.PLAIN_ROLES
    joined = product.filter("is_active").join(sales, "product_key", "left")
    return joined.select(
        "product_id", "product_name", "category", "subcategory", "brand", "unit_price",
        *[(F.lit(None).cast(product.schema[c].dataType) if hide else F.col(c)).alias(c)
          for c in ("unit_cost", "profit_margin")],
        F.coalesce("times_ordered", F.lit(0)).alias("times_ordered"), "units_sold", "total_revenue",
    )


def sales_by_region(fact: DataFrame, calendar: DataFrame, store: DataFrame, mapping: DataFrame,
                    user: str) -> DataFrame:
    """All fact columns for the region the user is mapped to; an unmapped user sees all."""
    seen = store.filter(can_access_region(mapping, user, F.col("region"))).select("store_key", "store_name", "region")
    return fact.join(calendar.select("date_key", "full_date"), "date_key").join(small_side(seen), "store_key")
