"""Quality rules and reconciliation, all in one result shape.

Rules on one table are counted in one pass and turned into rows afterwards.
A rule counts rows for which its condition is true, so a NULL never fails it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.functions import dates as D
from martloom.functions.measures import count_if, pct
from martloom.operators.keys import duplicates, key_counts, orphan_count, orphan_counts
from martloom.operators.shapes import by_rank, invalid_email, invalid_email_loose

PASS, WARNING, FAIL, ERROR, SKIP = "PASS", "WARNING", "FAIL", "ERROR", "SKIP"
# Accepted payment methods and the tolerated difference of an amount.
PAYMENT_METHODS = ("CREDIT_CARD", "DEBIT_CARD", "CASH", "PAYPAL")
AMOUNT_TOLERANCE = Decimal("0.01")


@dataclass(frozen=True)
class Rule:
    """A named rule: how many rows were checked and failed, and how that grades."""

    name: str
    category: str
    failed: Column
    note: str
    checked: Column | None = None
    threshold: float = 100.0
    pass_at: float | None = None
    warn_at: float | None = None
    on_fail: str = FAIL


def _grade(rule: Rule, rate: Column, failed: Column) -> Column:
    if rule.pass_at is None:
        return F.when(failed == 0, PASS).otherwise(rule.on_fail)
    out = F.when(rate >= rule.pass_at, PASS)
    return (out.when(rate >= rule.warn_at, WARNING) if rule.warn_at is not None else out).otherwise(FAIL)


def check(rows: DataFrame, layer: str, table: str, rules: Sequence[Rule]) -> DataFrame:
    """All rules on ``rows`` in one aggregation, one result row per rule."""
    aggregates = []
    for i, rule in enumerate(rules):
        total = rule.checked if rule.checked is not None else F.count("*")
        aggregates += [total.alias(f"t{i}"), rule.failed.alias(f"f{i}")]
    counted, out = rows.agg(*aggregates), []
    for i, rule in enumerate(rules):
        total, failed = F.col(f"t{i}").cast("bigint"), F.col(f"f{i}").cast("bigint")
        rate = pct(total - failed, total).cast("decimal(5,2)")
        out.append(F.struct(
            F.lit(layer).alias("layer_name"), F.lit(table).alias("table_name"), F.lit(rule.name).alias("rule_name"),
            F.lit(rule.category).alias("rule_category"), total.alias("records_checked"),
            (total - failed).alias("records_passed"), failed.alias("records_failed"), rate.alias("pass_rate"),
            _grade(rule, rate, failed).alias("status"),
            F.lit(rule.threshold).cast("decimal(5,2)").alias("threshold"),
            F.concat(failed.cast("string"), F.lit(" " + rule.note)).alias("details"),
        ))
    return counted.select(F.explode(F.array(*out)).alias("r")).select("r.*")


def union(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# Staging rules

def amount_off(total: Column, price: Column, quantity: Column, discount: Column) -> Column:
    """True if the total misses price x quantity less discount by more than the tolerance."""
    return F.abs(total - price * quantity * (1 - discount / 100)) > F.lit(AMOUNT_TOLERANCE)


def _sales_faults() -> dict[str, Column]:
    return {
        "ORDER_ID_NOT_NULL": F.col("order_id").isNull(),
        "QUANTITY_POSITIVE": F.col("quantity") <= 0,
        "AMOUNT_CALCULATION": amount_off(F.col("total_amount"), F.col("unit_price"), F.col("quantity"),
                                         F.col("discount_percent")),
    }


def validate_sales(sales: DataFrame) -> DataFrame:
    faults = _sales_faults() | {"VALID_PAYMENT_METHOD": ~F.col("payment_method").isin(list(PAYMENT_METHODS))}
    return check(sales, "STAGING", "STG_SALES",
                 [Rule(name, "VALIDITY", count_if(bad), "failed rows") for name, bad in faults.items()])


def _mark(rows: DataFrame, faults: Sequence[Column]) -> DataFrame:
    bad = F.lit(False)
    for fault in faults:
        bad = bad | F.coalesce(fault, F.lit(False))
    return rows.withColumn("dq_is_valid", ~bad).withColumn(
        "dq_error_details", F.when(bad, "Failed validation"))


def mark_sales(sales: DataFrame) -> DataFrame:
    """Flags rows that break a rule; the payment method does not flag."""
    return _mark(sales, list(_sales_faults().values()))


def validate_customers(customers: DataFrame, as_of: dt.date) -> DataFrame:
    return check(customers, "STAGING", "STG_CUSTOMERS", [
        Rule("CUSTOMER_ID_NOT_NULL", "VALIDITY", count_if(F.col("customer_id").isNull()), "failed rows"),
        Rule("VALID_EMAIL_FORMAT", "VALIDITY", count_if(invalid_email(F.col("email"))), "failed rows"),
        Rule("REGISTRATION_NOT_FUTURE", "VALIDITY", count_if(F.col("registration_date") > D.day(as_of)),
             "failed rows"),
    ])


def mark_customers(customers: DataFrame, as_of: dt.date) -> DataFrame:
    return _mark(customers, [F.col("customer_id").isNull(), F.col("registration_date") > D.day(as_of)])


def mark_clicks(events: DataFrame) -> DataFrame:
    """Flags events without an id, session, time or type."""
    return _mark(events, [F.col(c).isNull() for c in ("event_id", "session_id", "event_timestamp", "event_type")])


def mark_inventory(stock: DataFrame) -> DataFrame:
    """Flags counts without an id, product, store or time, and negative ones."""
    missing = [F.col(c).isNull() for c in ("inventory_id", "product_id", "store_id", "snapshot_timestamp")]
    return _mark(stock, [*missing, F.col("quantity_on_hand") < 0, F.col("quantity_reserved") < 0])


# Curated rules by dimension of quality

def _missing(column: str) -> Column:
    return count_if(F.col(column).isNull())


def completeness(customer: DataFrame, fact: DataFrame, product: DataFrame) -> DataFrame:
    required = F.col("date_key").isNull() | F.col("order_id").isNull() | F.col("net_amount").isNull()
    return union([
        check(customer.filter("is_current"), "CURATED", "DIM_CUSTOMER", [
            Rule("EMAIL_NOT_NULL", "COMPLETENESS", _missing("email"), "customers missing email",
                 threshold=95, pass_at=95, warn_at=90)]),
        check(fact, "CURATED", "FACT_SALES", [
            Rule("REQUIRED_FIELDS_NOT_NULL", "COMPLETENESS", count_if(required),
                 "records missing required fields (date_key, order_id, net_amount)", threshold=99, pass_at=99)]),
        check(product, "CURATED", "DIM_PRODUCT", [
            Rule("PRODUCT_NAME_NOT_NULL", "COMPLETENESS", _missing("product_name"), "products missing name",
                 threshold=99, pass_at=99)]),
    ])


def _unique(rows: DataFrame, table: str, name: str, keys: Sequence[str], note: str) -> DataFrame:
    """Counts per key first, so a key held by a third of the rows is one row in the second step."""
    per_key = rows.groupBy(*keys).agg(F.count("*").alias("_n"))
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    total = F.coalesce(F.sum("_n"), F.lit(0))
    return check(per_key, "CURATED", table, [
        Rule(name, "UNIQUENESS", total - count_if(whole), note, checked=total)])


def uniqueness(customer: DataFrame, fact: DataFrame, calendar: DataFrame) -> DataFrame:
    return union([
        _unique(customer.filter("is_current"), "DIM_CUSTOMER", "UNIQUE_CUSTOMER_ID_CURRENT", ["customer_id"],
                "duplicate customer_ids in current records"),
        _unique(fact, "FACT_SALES", "UNIQUE_ORDER_LINE", ["order_id", "order_line_id"],
                "duplicate order line records"),
        _unique(calendar, "DIM_DATE", "UNIQUE_DATE_KEY", ["date_key"], "duplicate date keys"),
    ])


def accuracy(customer: DataFrame, fact: DataFrame) -> DataFrame:
    quantity, discount = F.col("quantity"), F.col("discount_percent")
    return union([
        check(fact, "CURATED", "FACT_SALES", [
            Rule("NET_AMOUNT_POSITIVE", "ACCURACY", count_if(F.col("net_amount") < 0),
                 "records with negative net_amount", threshold=99, on_fail=WARNING),
            Rule("QUANTITY_IN_RANGE", "ACCURACY", count_if((quantity < 1) | (quantity > 1000)),
                 "records with quantity outside 1-1000 range", threshold=99, on_fail=WARNING),
            Rule("DISCOUNT_PCT_IN_RANGE", "ACCURACY", count_if((discount < 0) | (discount > 100)),
                 "records with discount_percent outside 0-100 range"),
        ]),
        check(customer.filter(F.col("is_current") & F.col("email").isNotNull()), "CURATED", "DIM_CUSTOMER", [
            Rule("EMAIL_FORMAT_VALID", "ACCURACY", count_if(invalid_email_loose(F.col("email"))),
                 "customers with invalid email format", threshold=98, on_fail=WARNING)]),
    ])


def _fact_parents(customer: DataFrame, product: DataFrame, calendar: DataFrame) -> dict:
    return {"customer_key": (customer, "customer_key", False), "product_key": (product, "product_key", False),
            "date_key": (calendar, "date_key", True)}


def _fact_orphans(fact: DataFrame, customer: DataFrame, product: DataFrame, calendar: DataFrame) -> DataFrame:
    parents = _fact_parents(customer, product, calendar)
    return orphan_counts(key_counts(fact, {k: [k] for k in parents}), parents)


def consistency(customer: DataFrame, fact: DataFrame, product: DataFrame, calendar: DataFrame) -> DataFrame:
    """Foreign keys of the fact, all from one pass over it, and one current version per customer."""
    current = customer.filter("is_current").groupBy("customer_id").agg(F.count("*").alias("cnt"))
    names = {"customer_key": "FK_CUSTOMER_INTEGRITY", "product_key": "FK_PRODUCT_INTEGRITY", "date_key": "FK_DATE_INTEGRITY"}
    return union([
        check(_fact_orphans(fact, customer, product, calendar), "CURATED", "FACT_SALES", [
            Rule(name, "CONSISTENCY", F.sum(f"orphans_{key}"), f"orphan {key} references in FACT_SALES",
                 checked=F.sum(f"checked_{key}")) for key, name in names.items()]),
        check(current, "CURATED", "DIM_CUSTOMER", [
            Rule("SCD2_ONE_CURRENT_PER_KEY", "CONSISTENCY", count_if(F.col("cnt") > 1),
                 "customers with multiple current records", checked=F.count("customer_id"))]),
    ])


def timeliness(rows: DataFrame, table: str, column: str, now: dt.datetime, hours: int = 24) -> DataFrame:
    """One check: was anything loaded in the last ``hours``?"""
    limit = F.lit(str(now - dt.timedelta(hours=hours))).cast("timestamp_ntz")
    last = rows.agg(F.max(column).alias("last"))
    result = check(last, "CURATED", table, [
        Rule("DATA_FRESHNESS_24H", "TIMELINESS", F.count("*") - count_if(F.col("last") >= limit), "")])
    stamp = F.coalesce(F.date_format("last", "yyyy-MM-dd HH:mm:ss"), F.lit("NO DATA"))
    shown = last.select(F.concat(F.lit("Last load timestamp: "), stamp)).scalar()
    return result.withColumn("details", shown)


def run_all(results: Sequence[DataFrame], run_id: str, now: dt.datetime) -> DataFrame:
    """Log rows of one run; count its failures by ``run_id``."""
    return (
        union(results)
        .withColumn("run_id", F.lit(run_id))
        .withColumn("validation_timestamp", F.lit(str(now)).cast("timestamp_ntz"))
    )


def failures(log: DataFrame, run_id: str) -> DataFrame:
    return log.filter((F.col("run_id") == run_id) & (F.col("status") == FAIL)).agg(F.count("*").alias("failures"))


def latest_results(log: DataFrame) -> DataFrame:
    """Newest result per table and rule, worst first."""
    newest = Window.partitionBy("table_name", "rule_name").orderBy(F.desc("validation_timestamp"))
    return (
        log.withColumn("_rn", F.row_number().over(newest)).filter("_rn = 1")
        .select("validation_timestamp", "layer_name", "table_name", "rule_name", "rule_category", "records_checked",
                "records_failed", "pass_rate", "status", "threshold", "details")
        .orderBy(by_rank("status", [FAIL, WARNING]), "table_name", "rule_name")
    )


def daily_summary(log: DataFrame) -> DataFrame:
    status = F.col("status")
    return log.groupBy(F.to_date("validation_timestamp").alias("check_date"), "rule_category").agg(
        F.count("*").alias("total_checks"),
        count_if(status == PASS).alias("passed"),
        count_if(status == WARNING).alias("warnings"),
        count_if(status == FAIL).alias("failed"),
        pct(count_if(status == PASS), F.count("*")).alias("overall_pass_rate"),
    )


# Short checks: name, status, count, note

_CHECK, _TEST = ("check_name", "status", "error_count", "details"), ("test_name", "status", "details")


def _named(rows: DataFrame, tests: Sequence[tuple[str, Column, str]], columns: Sequence[str] = _CHECK) -> DataFrame:
    """(name, aggregate that counts what is bad, note) for each test: one pass, one row a test."""
    counted = rows.agg(*[F.coalesce(bad, F.lit(0)).cast("bigint").alias(f"n{i}") for i, (_, bad, _) in enumerate(tests)])
    out = []
    for i, (name, _, note) in enumerate(tests):
        n = F.col(f"n{i}")
        fields = [F.lit(name).alias(columns[0]), F.when(n == 0, PASS).otherwise(FAIL).alias(columns[1])]
        if len(columns) == 4:
            fields += [n.alias(columns[2]), F.lit(note).alias(columns[3])]
        else:
            fields.append(F.concat(n.cast("string"), F.lit(" " + note)).alias(columns[2]))
        out.append(F.struct(*fields))
    return counted.select(F.explode(F.array(*out)).alias("r")).select("r.*")


def curated_checks(fact: DataFrame, customer: DataFrame, calendar: DataFrame, as_of: dt.date) -> DataFrame:
    """Four checks of the fact from one pass over it: keys are counted, then joined to customers and to days to come."""
    future = calendar.filter(F.col("full_date") > D.day(as_of)).select(F.col("date_key").cast("string").alias("_day")).distinct()
    counts = key_counts(fact, {"customer": ["customer_key"], "line": ["order_id", "order_line_id"], "day": ["date_key"]},
                        {"negative": F.col("net_amount") < 0})
    known = customer.select(F.col("customer_key").cast("string").alias("_c")).filter("_c IS NOT NULL").distinct()
    kind, n = F.col("kind"), F.col("n")
    met = counts.join(known, (kind == "customer") & (F.col("k1") == F.col("_c")), "left").join(
        F.broadcast(future), (kind == "day") & (F.col("k1") == F.col("_day")), "left")
    orphan = (kind == "customer") & F.col("k1").isNotNull() & F.col("_c").isNull()
    return _named(met, [
        ("Orphan Customer Keys", F.sum(F.when(orphan, n)), "Fact records without matching customer dimension"),
        ("Negative Net Amounts", F.sum(F.when(kind == "negative", n)), "Sales with negative net_amount"),
        ("Future Transaction Dates", F.sum(F.when(F.col("_day").isNotNull(), n)), "Transactions dated in the future"),
        ("Duplicate Order Lines", count_if((kind == "line") & (n > 1)), "Duplicate order_id + order_line_id combinations"),
    ])


def foreign_key_tests(fact: DataFrame, customer: DataFrame, product: DataFrame, calendar: DataFrame) -> DataFrame:
    return _named(_fact_orphans(fact, customer, product, calendar), [
        (name, F.sum(f"orphans_{key}"), "orphan records") for name, key in (
            ("FACT_SALES_CUSTOMER_FK", "customer_key"), ("FACT_SALES_PRODUCT_FK", "product_key"),
            ("FACT_SALES_DATE_FK", "date_key"))], _TEST)


def reconcile_counts(staged_sales: DataFrame, fact: DataFrame, staged_customers: DataFrame,
                     customer: DataFrame) -> DataFrame:
    parts = [("STAGING", "STG_SALES", staged_sales.filter("dq_is_valid")), ("CURATED", "FACT_SALES", fact),
             ("STAGING", "STG_CUSTOMERS", staged_customers.filter("dq_is_valid")),
             ("CURATED", "DIM_CUSTOMER (current)", customer.filter("is_current"))]
    return union([
        rows.agg(F.count("*").alias("row_count")).select(
            F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), "row_count")
        for layer, table, rows in parts
    ])


def scd2_tests(dimension: DataFrame, key: str = "customer_id") -> DataFrame:
    current = dimension.filter("is_current")
    return union([
        _named(duplicates(current, [key]), [("ONE_CURRENT_PER_CUSTOMER", F.count("*"),
                                             "customers with multiple current records")], _TEST),
        _named(current, [("CURRENT_END_DATE_NULL", count_if(F.col("end_date").isNotNull()),
                          "current records with non-null end_date")], _TEST),
    ])


def scd2_gaps(dimension: DataFrame, key: str = "customer_id") -> DataFrame:
    """Versions whose next version does not start the day after they end.

    One key has at most one version per day, which bounds the window.
    """
    w = Window.partitionBy(key).orderBy("effective_date")
    return dimension.withColumn("_next", F.lead("effective_date").over(w)).filter(
        F.col("_next").isNotNull() & ~F.col("_next").eqNullSafe(F.date_add("end_date", 1))).drop("_next")


def data_flow_tests(staged_sales: DataFrame, fact: DataFrame, calendar: DataFrame, customer: DataFrame,
                    summary: DataFrame) -> DataFrame:
    """Counts match within one percent, dates are covered, the customer and summary tables are filled."""
    staged = staged_sales.filter("dq_is_valid").agg(F.count("*").alias("s"))
    both = fact.agg(F.count("*").alias("c")).withColumn("s", staged.scalar())
    close = (F.col("s") == F.col("c")) | (
        F.abs(F.col("s") - F.col("c")) / F.nullif(F.col("s").cast("double"), F.lit(0.0)) < 0.01)
    match = both.select(
        F.lit("SALES_ROW_COUNT_MATCH").alias("test_name"), F.when(close, PASS).otherwise(FAIL).alias("status"),
        F.concat(F.lit("Staging valid rows: "), "s", F.lit(", Curated rows: "), "c").alias("details"))

    def filled(rows, name, note):
        return rows.agg(F.count("*").alias("n")).select(
            F.lit(name).alias("test_name"), F.when(F.col("n") > 0, PASS).otherwise(FAIL).alias("status"),
            F.concat(F.col("n").cast("string"), F.lit(" " + note)).alias("details"))

    return union([
        match,
        _named(orphan_count(fact, calendar, "date_key", True), [
            ("DATE_DIM_COVERAGE", F.sum("orphans"), "fact records with dates not in DIM_DATE")], _TEST),
        filled(customer.filter("is_current"), "CUSTOMER_DIM_HAS_CURRENT", "current customer records"),
        filled(summary, "MV_DAILY_SALES_POPULATED", "rows in MV_DAILY_SALES_SUMMARY"),
    ])


def transform_tests(fact: DataFrame, product: DataFrame, customer: DataFrame) -> DataFrame:
    off = F.abs(F.col("gross_amount") - F.col("unit_price") * F.col("quantity")) > F.lit(AMOUNT_TOLERANCE)
    over = F.col("net_amount") > F.col("gross_amount") + F.lit(AMOUNT_TOLERANCE)
    margin = F.col("profit_margin")
    return union([
        _named(fact, [
            ("GROSS_AMOUNT_CALC", count_if(off), "records where gross_amount != unit_price * quantity"),
            ("NET_LESS_THAN_GROSS", count_if(over), "records where net_amount > gross_amount")], _TEST),
        _named(customer.filter("is_current"), [("SCD2_DATE_CONTINUITY", count_if(F.col("end_date").isNotNull()),
                                                "customers with date gaps in SCD2 history")], _TEST),
        _named(scd2_gaps(customer), [("SCD2_VERSION_GAPS", F.count("*"), "versions not followed by the next day")], _TEST),
        _named(product, [("PROFIT_MARGIN_VALID", count_if((margin < 0) | (margin > 100)),
                          "products with profit_margin outside 0-100 range")], _TEST),
    ])


def latest_tests(log: DataFrame) -> DataFrame:
    """Newest result per test, worst first."""
    newest = Window.partitionBy("test_name").orderBy(F.desc("test_timestamp"))
    return (
        log.withColumn("_rn", F.row_number().over(newest)).filter("_rn = 1").drop("_rn")
        .orderBy(by_rank("status", [FAIL, ERROR, SKIP]), "test_suite", "test_name")
    )


def tables_exist(present: Sequence[str], expected: dict[str, tuple[Sequence[str], int]]) -> list[tuple[str, str, str]]:
    """Per test: are at least ``n`` of the expected tables there? Names only, so plain Python."""
    out = []
    for test, (names, least) in expected.items():
        n = sum(1 for name in names if name in set(present))
        out.append((test, PASS if n >= least else FAIL, f"{n} found (expected >= {least})"))
    return out


def reconcile_sums(fact: DataFrame, summary: DataFrame, value: str, summary_value: str) -> DataFrame:
    """Fact total against summary total."""
    total = fact.agg(F.sum(value).alias("fact_total"))
    return total.withColumn("summary_total", summary.agg(F.sum(summary_value)).scalar()).select(
        F.lit("SUMMARY_TOTAL_MATCH").alias("test_name"),
        F.when(F.col("fact_total").eqNullSafe(F.col("summary_total")), PASS).otherwise(FAIL).alias("status"),
        "fact_total", "summary_total")


def missing_days(calendar: DataFrame, daily: DataFrame, day: str, first: dt.date, last: dt.date) -> DataFrame:
    """Calendar days between two dates without a row in ``daily``."""
    have = daily.select(F.col(day).alias("full_date")).distinct()
    return calendar.filter(F.col("full_date").between(D.day(first), D.day(last))).select("full_date").join(
        have, "full_date", "left_anti")
