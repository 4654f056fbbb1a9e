import datetime as dt

import pytest
from pyspark.sql import functions as F

from martloom.functions.tables import can_access_region
from martloom.operators import access, lineage, quality
from martloom.plans import pipeline

AS_OF = dt.date(2024, 1, 20)


def _by_rule(df):
    return {r["rule_name"]: r for r in df.collect()}


def test_empty_table_grades(spark):
    customer = spark.createDataFrame([], "customer_id string, email string, is_current boolean, end_date date")
    fact = spark.createDataFrame([], "date_key int, order_id string, order_line_id int, net_amount decimal(12,2)")
    product = spark.createDataFrame([], "product_name string")
    calendar = spark.createDataFrame([], "date_key int")
    rates = _by_rule(quality.completeness(customer, fact, product))
    assert rates["EMAIL_NOT_NULL"]["status"] == "FAIL" and rates["EMAIL_NOT_NULL"]["pass_rate"] is None
    counts = _by_rule(quality.uniqueness(customer, fact, calendar))
    assert {r["status"] for r in counts.values()} == {"PASS"}
    assert all(r["records_checked"] == 0 for r in counts.values())


@pytest.mark.parametrize("missing, status", [(5, "PASS"), (6, "WARNING"), (10, "WARNING"), (11, "FAIL")])
def test_email_thresholds(spark, missing, status):
    customer = spark.range(100).select(
        F.when(F.col("id") >= missing, "a@b.co").alias("email"), F.lit(True).alias("is_current"))
    one = spark.createDataFrame([(1, "o", 1)], "date_key int, order_id string, net_amount int")
    product = spark.createDataFrame([("p",)], "product_name string")
    assert _by_rule(quality.completeness(customer, one, product))["EMAIL_NOT_NULL"]["status"] == status


def test_null_never_fails_a_comparison(spark):
    sales = spark.createDataFrame(
        [("O1", None, 10.0, 1, 0.0, None), (None, 1, 10.0, 1, 0.0, "CASH"), ("O2", 0, 0.0, 1, 0.0, "CASH"),
         ("O3", 1, 10.02, 10, 0.0, "CHEQUE")],
        "order_id string, quantity int, total_amount double, unit_price int, discount_percent double, "
        "payment_method string")
    failed = {n: r["records_failed"] for n, r in _by_rule(quality.validate_sales(sales)).items()}
    assert failed == {"ORDER_ID_NOT_NULL": 1, "QUANTITY_POSITIVE": 1, "AMOUNT_CALCULATION": 2,
                      "VALID_PAYMENT_METHOD": 1}
    valid = [r["order_id"] for r in quality.mark_sales(sales).filter("dq_is_valid").collect()]
    assert valid == ["O1"]


@pytest.mark.parametrize("role, user, regions", [
    ("RETAIL_ADMIN", "x", {"West", "South", None}), ("RETAIL_VIEWER", "DATA_ANALYST_02", {"West"}),
    ("RETAIL_VIEWER", "DATA_ENGINEER_01", {"West", "South", None}),
    ("RETAIL_VIEWER", "BI_VIEWER", {"West", "South", None}), ("RETAIL_VIEWER", "nobody", set())])
def test_region_policy(spark, role, user, regions):
    rows = spark.createDataFrame([("West",), ("South",), (None,)], "region string")
    seen = access.by_region_policy(rows, access.region_mapping(spark), "region", role, user)
    assert {r["region"] for r in seen.collect()} == regions


@pytest.mark.parametrize("role, user, count", [
    ("ACCOUNTADMIN", "x", 3), ("none", "REGIONAL_MANAGER_WEST", 1), ("RETAIL_ANALYST", "x", 2),
    ("none", "VP_SALES", 3), ("none", "nobody", 0)])
def test_view_access(spark, role, user, count):
    rows = spark.createDataFrame([("West",), ("South",), ("Other",)], "region string")
    assert access.by_view_access(rows, access.region_access(spark), "region", role, user).count() == count


def test_segment_policy_and_user_region(spark):
    rows = spark.createDataFrame([("VIP",), ("STANDARD",)], "segment string")
    mapping = access.segment_access(spark)
    assert access.by_segment_policy(rows, mapping, "segment", "RETAIL_VIEWER", "DATA_ANALYST_02").count() == 1
    assert access.by_segment_policy(rows, mapping, "segment", "RETAIL_ADMIN", "x").count() == 2
    regions = spark.createDataFrame([("West",), ("South",)], "region string")
    mapped = access.region_mapping(spark)
    for user, seen in (("DATA_ANALYST_02", 1), ("nobody", 2), ("DATA_ENGINEER_01", 2)):
        assert regions.filter(can_access_region(mapped, user, F.col("region"))).count() == seen


def test_impact_with_a_cycle(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("b", "d")],
                                  "source_object string, target_object string").withColumn("target_type", F.lit("T"))
    found = {(r["level"], r["object_path"]) for r in lineage.impact(edges, "a", 5).collect()}
    assert found == {(1, "b"), (2, "c"), (2, "d"), (3, "a"), (4, "b"), (5, "c"), (5, "d")}


def test_layer_lineage(spark):
    edges = pipeline.lineage_edges(spark)
    assert lineage.downstream(edges, "curated.fact_sales").count() == 4
    assert {r["source_object"] for r in lineage.upstream(edges, "analytics.customer_360").collect()} == {
        "curated.fact_sales", "curated.dim_customer"}
    assert lineage.impact(edges, "landing.sales").filter("level = 3").count() == 4
    assert lineage.lineage_map(edges).filter("source_layer = 'staging' AND target_layer = 'curated'").count() == 4


def test_foreign_keys_take_one_pass_over_the_fact(spark):
    from martloom.operators import quality
    from martloom.plans.star import Star

    star = Star(spark, "/root/testdata/sf0.001")
    for frame in (quality.foreign_key_tests(star.fact_sales, star.dim_customer, star.dim_product, star.dim_date),
                  quality.consistency(star.dim_customer, star.fact_sales, star.dim_product, star.dim_date),
                  quality.curated_checks(star.fact_sales, star.dim_customer, star.dim_date, star.as_of),
                  quality.transform_tests(star.fact_sales, star.dim_product, star.dim_customer.withColumn("k", F.lit(1)))):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("l_linenumber") and plan.count("lineitem") <= 1 or plan.count("Relation [l_orderkey") == 1


def test_orphans_of_several_kinds_with_hot_and_empty_keys(spark):
    from martloom.operators.keys import key_counts, orphan_counts

    rows = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN 7 ELSE id END AS a", "id % 5 AS b")
    a, b = spark.createDataFrame([(7,), (7,), (None,)], "a long"), spark.createDataFrame([(0,), (1,)], "b long")
    parents = {"a": (a, "a", False), "b": (b, "b", True)}
    assert orphan_counts(key_counts(rows, {"a": ["a"], "b": ["b"]}), parents).first().asDict() == {
        "checked_a": 2000, "orphans_a": 1000, "checked_b": 3000, "orphans_b": 1800}
    assert set(orphan_counts(key_counts(rows.limit(0), {"a": ["a"], "b": ["b"]}), parents).first()) == {0}
