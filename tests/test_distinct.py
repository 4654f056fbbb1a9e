"""Distinct counts by marks: as Spark counts them, and without copies of the rows."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from martloom.operators.distinct import mark_first

FOLDER = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["mv_daily_sales_summary", "mv_product_performance", "agg_daily_sales", "agg_monthly_sales",
                                  "kpi_executive_summary", "kpi_product_metrics", "kpi_regional_performance", "fact_quality_summary"])
def test_no_row_is_copied(spark, name):
    assert "Expand" not in _plan(entry.queries()[name](spark, FOLDER))


def test_marks_count_like_distinct(spark):
    rows = spark.range(4000).selectExpr(
        "CASE WHEN id % 3 > 0 THEN NULL ELSE id % 7 END AS k", "CASE WHEN id % 2 = 0 THEN id % 91 END AS o", "id % 13 AS c")
    got = mark_first(rows, ["k"], "o", "m").groupBy("k").agg(F.sum("m").alias("n"), F.countDistinct("c").alias("c"))
    want = rows.groupBy("k").agg(F.countDistinct("o").alias("n"), F.countDistinct("c").alias("c"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_rows_without_an_id_do_not_meet(spark):
    rows = spark.range(20000).selectExpr("1 AS k", "CAST(NULL AS BIGINT) AS o", "id")
    marked = mark_first(rows, ["k"], "o", "m").withColumn("p", F.spark_partition_id())
    assert marked.agg(F.sum("m")).first()[0] == 0
    assert max(r["count"] for r in marked.groupBy("p").count().collect()) < 12000
