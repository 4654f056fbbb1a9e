"""Sales and customer marts.

Facts are joined to the three or four columns a mart needs, grouped by the
integer date key, and the calendar columns are attached after grouping.
Group keys are coarse, so partial aggregation runs before each shuffle, and
a distinct count shuffles (group, id) pairs, which spreads a hot group. Where
customers are counted too, orders are counted by a mark on one line of each.
Groups of a day by several columns are fine: their rows are dealt out first,
in parts of an even size.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions import dates as D
from martloom.functions.measures import average, count_if, mean, pct, ratio
from martloom.operators import periods
from martloom.operators.distinct import mark_first
from martloom.operators.keys import attach_scalars, small_side, spread


def _distinct(column: str) -> Column:
    return F.countDistinct(column)


def _by_line(fact: DataFrame, store: DataFrame | None = None, store_cols: Sequence[str] = (),
             product: DataFrame | None = None, product_cols: Sequence[str] = ()) -> DataFrame:
    """Star join restricted to the named dimension columns."""
    if store is not None:
        fact = fact.join(small_side(store.select("store_key", *store_cols)), "store_key")
    if product is not None:
        fact = fact.join(small_side(product.select("product_key", *product_cols)), "product_key")
    return fact


#: What the daily marts sum up or count.
MEASURES = ("quantity", "gross_amount", "discount_amount", "net_amount", "discount_percent")


def _by_group(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Lines with a date and the columns that a daily mart needs, dealt out by group: one shuffle serves the marks, the
    distinct customers and the sums. A group is at most a part of one day."""
    known = lines.filter(F.col("date_key").isNotNull())
    return spread(known.select(*keys, "order_id", "customer_key", *MEASURES), *keys)


def _by_order(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Lines with a date, dealt out by group and order for a distinct count of orders in groups that hardly repeat one.

    (group, order) is nearly a row, so a task's tables grow with its rows: those are kept to an even number.
    """
    known = lines.filter(F.col("date_key").isNotNull()).withColumnRenamed("category", "product_category")
    return spread(known.select(*keys, "order_id", *[m for m in MEASURES if m in lines.columns]), *keys, "order_id")


def _on_calendar(by_day: DataFrame, calendar: DataFrame, columns: dict[str, str]) -> DataFrame:
    picked = [F.col(source).alias(out) for source, out in columns.items()]
    return by_day.join(calendar.select("date_key", *picked), "date_key").drop("date_key")


def daily_sales_summary(fact: DataFrame, calendar: DataFrame, store: DataFrame, product: DataFrame) -> DataFrame:
    keys = ["date_key", "region", "store_type", "product_category"]
    lines = _by_line(fact, store, ["region", "store_type"], product, ["category"])
    by_day = (
        mark_first(_by_group(lines.withColumnRenamed("category", "product_category"), keys), keys, "order_id", "_order")
        .groupBy(*keys)
        .agg(
            F.sum("_order").alias("order_count"),
            _distinct("customer_key").alias("unique_customers"),
            F.sum("quantity").alias("units_sold"),
            F.sum("gross_amount").alias("gross_revenue"),
            F.sum("discount_amount").alias("total_discounts"),
            F.sum("net_amount").alias("net_revenue"),
            average(F.col("net_amount")).alias("avg_order_value"),
            average(F.col("discount_percent")).alias("avg_discount_pct"),
        )
    )
    return _on_calendar(by_day, calendar, {
        "full_date": "sales_date", "day_name": "day_name", "week_of_year": "week_of_year",
        "month_number": "month_number", "month_name": "month_name", "year_number": "year_number",
        "is_weekend": "is_weekend",
    })


def daily_sales_by_store(fact: DataFrame, calendar: DataFrame, store: DataFrame, product: DataFrame) -> DataFrame:
    keys = ["date_key", "region", "store_name", "product_category"]
    by_day = (
        _by_order(_by_line(fact, store, ["region", "store_name"], product, ["category"]), keys)
        .groupBy(*keys)
        .agg(
            _distinct("order_id").alias("order_count"),
            F.sum("quantity").alias("units_sold"),
            F.sum("gross_amount").alias("gross_revenue"),
            F.sum("discount_amount").alias("total_discounts"),
            F.sum("net_amount").alias("net_revenue"),
            average(F.col("net_amount")).alias("avg_order_value"),
        )
    )
    return _on_calendar(by_day, calendar, {
        "full_date": "sales_date", "day_name": "day_name", "month_name": "month_name", "year_number": "year_number",
    })


#: What a group of the daily and of the monthly mart is.
DAILY_KEYS = ("region", "store_type", "product_category", "customer_segment")
MONTHLY_KEYS = ("region", "product_category")


def daily_groups(fact: DataFrame, store: DataFrame, product: DataFrame, customer: DataFrame) -> DataFrame:
    """The daily mart's groups by date key, each from its own day's facts alone."""
    segments = customer.filter("is_current").select("customer_key", "customer_segment")
    keys = list(DAILY_KEYS)
    lines = (
        _by_line(fact, store, ["region", "store_type"], product, ["category"])
        .join(small_side(segments), "customer_key", "left")
        .withColumnRenamed("category", "product_category")
    )
    return (
        mark_first(_by_group(lines, ["date_key", *keys]), ["date_key", *keys], "order_id", "_order")
        .groupBy("date_key", *keys)
        .agg(
            F.sum("_order").alias("order_count"),
            _distinct("customer_key").alias("unique_customers"),
            F.sum("quantity").alias("units_sold"),
            F.sum("gross_amount").alias("gross_revenue"),
            F.sum("discount_amount").alias("total_discounts"),
            F.sum("net_amount").alias("net_revenue"),
            mean(F.col("net_amount")).alias("avg_order_value"),
            mean(F.col("discount_percent")).alias("avg_discount_pct"),
        )
    )


def daily_from_groups(groups: DataFrame, calendar: DataFrame) -> DataFrame:
    """The daily mart from its groups: sale dates and two earlier periods."""
    keys = list(DAILY_KEYS)
    out = _on_calendar(groups, calendar, {"full_date": "sale_date"})
    out = periods.with_lag(out, keys, ["sale_date"], "net_revenue", 1, "prev_day_revenue", "dod_revenue_change_pct")
    return periods.with_lag(out, keys, ["sale_date"], "net_revenue", 7,
                            "same_day_last_week_revenue", "wow_revenue_change_pct")


def daily_sales(fact: DataFrame, calendar: DataFrame, store: DataFrame, product: DataFrame,
                customer: DataFrame) -> DataFrame:
    """Daily mart by region, store type, category and segment, with two earlier periods."""
    return daily_from_groups(daily_groups(fact, store, product, customer), calendar)


def monthly_groups(fact: DataFrame, calendar: DataFrame, store: DataFrame, product: DataFrame) -> DataFrame:
    """The monthly mart's groups, each from its own month's facts alone."""
    months = calendar.select("date_key", "year_number", "month_number", "month_name")
    groups = ["year_number", "month_number", "month_name", "region", "product_category"]
    lines = (
        _by_line(fact, store, ["region"], product, ["category"])
        .join(months, "date_key").withColumnRenamed("category", "product_category")
    )
    return (
        mark_first(lines.select(*groups, "order_id", "customer_key", "quantity", "net_amount"), groups, "order_id", "_order")
        .groupBy(*groups)
        .agg(
            F.sum("_order").alias("order_count"),
            _distinct("customer_key").alias("unique_customers"),
            F.sum("quantity").alias("units_sold"),
            F.sum("net_amount").alias("net_revenue"),
            mean(F.col("net_amount")).alias("avg_order_value"),
        )
    )


def monthly_from_groups(groups: DataFrame) -> DataFrame:
    """The monthly mart from its groups: two earlier periods and the year to date."""
    out, keys, order = groups, list(MONTHLY_KEYS), ["year_number", "month_number"]
    out = periods.with_lag(out, keys, order, "net_revenue", 1, "prev_month_revenue", "mom_change_pct")
    out = periods.with_lag(out, keys, order, "net_revenue", 12, "same_month_last_year_revenue", "yoy_change_pct")
    return periods.running_sum(out, ["year_number", *keys], ["month_number"], "net_revenue", "ytd_revenue")


def monthly_sales(fact: DataFrame, calendar: DataFrame, store: DataFrame, product: DataFrame) -> DataFrame:
    return monthly_from_groups(monthly_groups(fact, calendar, store, product))


def customer_activity(fact: DataFrame, calendar: DataFrame, keys: Sequence[str] = ("customer_key",)) -> DataFrame:
    """Purchases per customer, grouped before any customer column is joined."""
    days = calendar.select("date_key", "full_date")
    return (
        fact.filter(F.col(keys[0]).isNotNull())
        .join(days, "date_key", "left")
        .groupBy(*keys)
        .agg(
            _distinct("order_id").alias("total_orders"),
            F.sum("quantity").alias("total_items_purchased"),
            F.sum("net_amount").alias("lifetime_value"),
            average(F.col("net_amount")).alias("avg_order_value"),
            F.min("full_date").alias("first_purchase_date"),
            F.max("full_date").alias("last_purchase_date"),
        )
    )


def with_activity(customer: DataFrame, fact: DataFrame, calendar: DataFrame, by: str = "customer_key") -> DataFrame:
    """Current customers with their purchases; idle ones stay, with zero orders.

    ``by="customer_key"`` counts only facts that point at the current version, so
    the totals restart when a customer changes; ``by="customer_id"`` counts the
    facts of all versions.
    """
    current = customer.filter("is_current")
    if by == "customer_id":
        versions = customer.select("customer_key", "customer_id")
        activity = customer_activity(fact.join(versions, "customer_key"), calendar, ["customer_id"])
    else:
        activity = customer_activity(fact, calendar)
    return current.join(activity, by, "left").withColumn("total_orders", F.coalesce("total_orders", F.lit(0)))


def customer_360(customer: DataFrame, fact: DataFrame, calendar: DataFrame, as_of: dt.date,
                 by: str = "customer_key") -> DataFrame:
    return customer_overview(with_activity(customer, fact, calendar, by), as_of)


def customer_overview(active: DataFrame, as_of: dt.date) -> DataFrame:
    """The columns of ``customer_360`` over current customers with their purchases."""
    today = D.day(as_of)
    return active.select(
        "customer_key", "customer_id", "full_name", "email", "customer_segment", "loyalty_tier",
        "city", "state", "region", "registration_date",
        "total_orders", "total_items_purchased", "lifetime_value", "avg_order_value",
        "first_purchase_date", "last_purchase_date",
        F.datediff(today, "last_purchase_date").alias("days_since_last_purchase"),
        F.datediff(today, "registration_date").alias("customer_tenure_days"),
    )


def customer_360_short(customer: DataFrame, fact: DataFrame, calendar: DataFrame, as_of: dt.date) -> DataFrame:
    return customer_360(customer, fact, calendar, as_of).drop(
        "email", "registration_date", "customer_tenure_days"
    ).withColumnRenamed("total_items_purchased", "total_items")


def customer_segments(customers: DataFrame, active_days: int = 90) -> DataFrame:
    """Segments over ``customer_360``; active means a purchase in the last ``active_days``."""
    bought = F.col("total_orders") > 0
    return customers.groupBy("customer_segment", "loyalty_tier", "region").agg(
        F.count("*").alias("customer_count"),
        count_if(F.col("days_since_last_purchase") <= active_days).alias("active_customer_count"),
        F.sum("total_orders").alias("total_orders"),
        F.sum("lifetime_value").alias("total_revenue"),
        mean(F.col("lifetime_value")).alias("avg_lifetime_value"),
        ratio(F.sum("lifetime_value"), F.sum("total_orders")).alias("avg_order_value"),
        ratio(F.sum("total_orders"), F.count("*")).alias("avg_orders_per_customer"),
        F.round(F.avg(F.when(bought, F.col("days_since_last_purchase"))), 1).alias("avg_days_since_last_purchase"),
    )


def product_activity(fact: DataFrame) -> DataFrame:
    lines = fact.select("product_key", "order_id", "customer_key", "quantity", "net_amount")
    return mark_first(lines, ["product_key"], "order_id", "_order").groupBy("product_key").agg(
        F.sum("_order").alias("times_ordered"),
        _distinct("customer_key").alias("unique_buyers"),
        F.sum("quantity").alias("units_sold"),
        F.sum("net_amount").alias("total_revenue"),
        F.avg("quantity").alias("avg_quantity_per_order"),
    )


def product_performance(product: DataFrame, fact: DataFrame) -> DataFrame:
    cost = F.col("units_sold") * F.col("unit_cost")
    return product.join(product_activity(fact), "product_key", "left").select(
        "product_key", "product_id", "product_name", "category", "subcategory", "brand",
        "unit_price", "unit_cost", "profit_margin",
        F.coalesce("times_ordered", F.lit(0)).alias("times_ordered"),
        F.coalesce("unique_buyers", F.lit(0)).alias("unique_buyers"),
        "units_sold", "total_revenue",
        cost.alias("total_cost"),
        (F.col("total_revenue") - cost).alias("total_profit"),
        "avg_quantity_per_order",
    )


def region_daily_report(fact: DataFrame, calendar: DataFrame, store: DataFrame, n: int = 20) -> DataFrame:
    by_day = _by_line(fact, store, ["region"]).groupBy("date_key", "region").agg(
        _distinct("order_id").alias("order_count"),
        F.sum("quantity").alias("units_sold"),
        F.sum("net_amount").alias("total_revenue"),
        mean(F.col("net_amount")).alias("avg_order_value"),
    )
    out = _on_calendar(by_day, calendar, {"full_date": "full_date", "day_name": "day_name"})
    return out.orderBy("full_date", "region").limit(n)


def product_report(fact: DataFrame, product: DataFrame, n: int = 20) -> DataFrame:
    return (
        _by_line(fact, None, (), product, ["category", "subcategory", "brand"])
        .groupBy("category", "subcategory", "brand")
        .agg(
            _distinct("order_id").alias("order_count"),
            F.sum("quantity").alias("units_sold"),
            F.sum("net_amount").alias("revenue"),
            F.sum(F.col("gross_amount") - F.col("net_amount")).alias("total_discount_given"),
        )
        .orderBy(F.desc_nulls_first("revenue"), "category", "subcategory", "brand")
        .limit(n)
    )


def customer_pattern_report(fact: DataFrame, customer: DataFrame) -> DataFrame:
    """Segment by tier over customers that bought; grouped per customer first."""
    per_customer = fact.groupBy("customer_key").agg(
        _distinct("order_id").alias("orders"), F.sum("net_amount").alias("revenue")
    )
    groups = customer.filter("is_current").select("customer_key", "customer_segment", "loyalty_tier")
    return (
        per_customer.join(groups, "customer_key")
        .groupBy("customer_segment", "loyalty_tier")
        .agg(
            F.count("*").alias("customer_count"),
            F.sum("orders").alias("total_orders"),
            F.sum("revenue").alias("total_revenue"),
            ratio(F.sum("revenue"), F.count("*")).alias("revenue_per_customer"),
            ratio(F.sum("orders"), F.count("*")).alias("orders_per_customer"),
        )
    )


def fact_quality_summary(fact: DataFrame) -> DataFrame:
    """Totals of all facts. Each distinct count is a pass over its own column."""
    totals = fact.agg(
        F.count("*").alias("total_rows"),
        F.min("transaction_timestamp").alias("earliest_transaction"),
        F.max("transaction_timestamp").alias("latest_transaction"),
        F.sum("net_amount").alias("total_revenue"),
        average(F.col("net_amount")).alias("avg_order_value"),
    )
    counted = {"order_id": "unique_orders", "customer_key": "unique_customers", "product_key": "unique_products",
               "store_key": "unique_stores"}
    for column, name in counted.items():
        # Grouped first: Spark would merge plain distinct counts into one pass again.
        ids = fact.filter(F.col(column).isNotNull()).select(column).distinct()
        totals = attach_scalars(totals, ids.agg(F.count("*").alias(name)))
    return totals.select("total_rows", *counted.values(), "earliest_transaction", "latest_transaction", "total_revenue",
                         "avg_order_value")


def category_summary(product: DataFrame) -> DataFrame:
    return product.groupBy("category", "subcategory").agg(
        F.count("*").alias("product_count"),
        F.avg("unit_price").alias("avg_price"),
        F.avg("profit_margin").alias("avg_margin"),
        F.count_if("is_active").alias("active_count"),
    )


def store_regional_summary(store: DataFrame) -> DataFrame:
    return store.filter("is_active").groupBy("region", "store_type").agg(
        F.count("*").alias("store_count"),
        F.sum("square_footage").alias("total_sqft"),
        F.avg("square_footage").alias("avg_sqft"),
        F.min("open_date").alias("earliest_open"),
        F.max("open_date").alias("latest_open"),
    )


def region_category_revenue(fact: DataFrame, calendar: DataFrame, store: DataFrame, product: DataFrame,
                            year: int) -> DataFrame:
    days = calendar.filter(F.col("year_number") == year).select("date_key")
    return (
        _by_line(fact.join(days, "date_key"), store, ["region"], product, ["category"])
        .groupBy("region", "category")
        .agg(_distinct("order_id").alias("orders"), F.sum("net_amount").alias("revenue"))
        .orderBy(F.desc("revenue"), "region", "category")
    )


def sales_report(fact: DataFrame, calendar: DataFrame, first: dt.date, last: dt.date, report_type: str,
                 generated_at: dt.datetime) -> DataFrame:
    """Totals between two dates, as one nested JSON object."""
    days = calendar.filter(F.col("full_date").between(D.day(first), D.day(last))).select("date_key")
    totals = fact.join(days, "date_key").agg(
        _distinct("order_id").alias("total_orders"), F.sum("net_amount").alias("total_revenue")
    )
    body = F.struct(
        F.lit(report_type).alias("report_type"),
        F.lit(str(first)).alias("start_date"),
        F.lit(str(last)).alias("end_date"),
        F.lit(generated_at.isoformat()).alias("generated_at"),
        F.struct("total_orders", "total_revenue").alias("metrics"),
    )
    return totals.select(F.to_json(body).alias("report"))


def status_rates(fact: DataFrame, store: DataFrame, done: str, dropped: str) -> DataFrame:
    status = F.upper("order_status")
    return _by_line(fact, store, ["region"]).groupBy("region").agg(
        F.count("*").alias("total_orders"),
        count_if(status == done).alias("completed"),
        count_if(status == dropped).alias("cancelled"),
        pct(count_if(status == done), F.count("*")).alias("completion_rate"),
    )


def shared_sales_summary(fact: DataFrame, calendar: DataFrame, store: DataFrame, product: DataFrame) -> DataFrame:
    """Extract for partners; holds no personal column."""
    keys = ["date_key", "region", "product_category", "brand"]
    by_day = (
        _by_order(_by_line(fact, store, ["region"], product, ["category", "brand"]), keys)
        .groupBy(*keys)
        .agg(
            _distinct("order_id").alias("order_count"),
            F.sum("quantity").alias("units_sold"),
            F.sum("net_amount").alias("net_revenue"),
            mean(F.col("net_amount")).alias("avg_order_value"),
        )
    )
    return _on_calendar(by_day, calendar, {
        "full_date": "sale_date", "month_name": "month_name", "year_number": "year_number",
    })


def monthly_revenue_by_store(fact: DataFrame, calendar: DataFrame, store: DataFrame) -> DataFrame:
    months = calendar.select("date_key", F.col("year_number").alias("year"), F.col("month_number").alias("month"))
    per_store = fact.join(months, "date_key").groupBy("year", "month", "store_key").agg(
        F.sum("net_amount").alias("revenue")
    )
    return per_store.join(store.select("store_key", F.col("store_name").alias("store")), "store_key").select(
        "year", "month", "store", "revenue"
    )


def customer_cohorts(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    """Customers and revenue by month of first purchase and months since."""
    months = calendar.select("date_key", F.col("month_start_date").alias("month"))
    per_month = (
        fact.filter(F.col("customer_key").isNotNull()).join(months, "date_key")
        .groupBy("customer_key", "month").agg(F.sum("net_amount").alias("revenue"))
    )
    first = per_month.groupBy("customer_key").agg(F.min("month").alias("cohort_month"))
    since = D.months_crossed(F.col("cohort_month"), F.col("month"))
    return (
        per_month.join(first, "customer_key")
        .groupBy("cohort_month", since.alias("months_since"))
        .agg(F.count("*").alias("customers"), F.sum("revenue").alias("revenue"))
    )


def conversion_funnel(events: DataFrame, key: str, steps: Sequence[str], event_type: str = "event_type") -> DataFrame:
    """Entities that reached each step and all steps before it."""
    reached = F.lit(True)
    flags = []
    for i, step in enumerate(steps):
        flags.append(F.max(F.col(event_type) == step).alias(f"_has{i}"))
    per_key = events.filter(F.col(key).isNotNull()).groupBy(key).agg(*flags)
    totals = []
    for i in range(len(steps)):
        reached = reached & F.col(f"_has{i}")
        totals.append(count_if(reached).alias(f"_n{i}"))
    counted = per_key.agg(*totals)
    rows = []
    for i, step in enumerate(steps):
        before = F.col(f"_n{i - 1}") if i else F.lit(None).cast("bigint")
        rows.append(F.struct(
            F.lit(i + 1).alias("step_number"), F.lit(step).alias("step"),
            F.col(f"_n{i}").alias("entities"), pct(F.col(f"_n{i}"), before).alias("rate_from_previous"),
        ))
    return counted.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
