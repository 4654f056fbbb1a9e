"""Parts that keep their size as tables grow, and caches that workers give back."""

import pytest
from pyspark.sql import functions as F

from martloom.llm import shipping
from martloom.operators import keys
from martloom.plans import marts
from martloom.plans.star import Star
from martloom.sources import sinks

FOLDER = "/root/testdata/sf0.001"


def test_parts_grow_with_the_source(spark, folder, monkeypatch):
    spark.range(20_000).withColumn("k", F.xxhash64("id")).write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")
    assert keys.pieces(rows) == 1 and keys.pieces(rows, 4) == 4
    monkeypatch.setattr(keys, "PIECE", keys.source_bytes(rows) // 12 + 1)
    assert keys.pieces(rows, 4) == 12
    sinks.write_clustered(rows, f"{folder}/sorted", ["k"], 4)
    written = spark.read.parquet(f"{folder}/sorted")
    files = written.groupBy(F.input_file_name()).agg(F.min("k").alias("lo"), F.max("k").alias("hi"), F.count("*").alias("n"))
    found = sorted(map(tuple, files.select("lo", "hi", "n").collect()))
    assert len(found) == 12 and sum(n for *_, n in found) == 20_000
    assert all(a[1] < b[0] for a, b in zip(found, found[1:]))


def test_raw_sales_land_in_more_files_of_a_larger_table(spark, monkeypatch):
    from martloom.catalog import files

    few = files._marked_sales(Star(spark, FOLDER))
    monkeypatch.setattr(keys, "PIECE", keys.source_bytes(Star(spark, FOLDER).fact_sales) // 10)
    many = files._marked_sales(Star(spark, FOLDER))
    assert few.select("source_file").distinct().count() == 4 < many.select("source_file").distinct().count()
    columns = [c for c in few.columns if c not in ("source_file", "file_row_number")]
    assert few.select(columns).exceptAll(many.select(columns)).isEmpty()


@pytest.mark.parametrize("mart", ["shared_sales_summary", "daily_sales_by_store", "daily_sales_summary", "daily_sales"])
def test_daily_marts_are_dealt_out_once_by_size(spark, monkeypatch, mart):
    star = Star(spark, FOLDER)
    sides = [star.dim_date, star.dim_store, star.dim_product, *([star.dim_customer] if mart == "daily_sales" else [])]
    build = lambda: getattr(marts, mart)(star.fact_sales, *sides)
    plain = build()
    monkeypatch.setattr(keys, "PIECE", 7_000)
    dealt = build()
    assert keys.pieces(star.fact_sales) > 4
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 1
    assert plan.count("Exchange hashpartitioning") <= plain._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    assert sorted(map(str, plain.collect())) == sorted(map(str, dealt.collect()))


def test_work_without_use_for_kept_results_sheds_them(spark):
    @shipping.kept(2)
    def table(n):
        return [0] * n

    table(10)
    assert table.cache_info().currsize == 1
    shipping.shed()
    assert table.cache_info().currsize == 0 and len(table(10)) == 10
    shipping._kept.remove(table)


def test_row_numbers_do_not_shuffle_the_rows(spark, folder):
    from martloom.sources import files

    spark.range(5000).selectExpr("concat('row ', id) AS a").repartition(3).write.option("header", "true").csv(f"{folder}/raw")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        read = files.read_delimited(spark, f"{folder}/raw", "a string")
        assert "SortMergeJoin" not in read._jdf.queryExecution().executedPlan().toString()
        places = read.groupBy("_source_file").agg(F.count("*").alias("n"), F.sum("_file_row_number").alias("s")).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert len(places) == 3 and sum(r["n"] for r in places) == 5000 and all(r["s"] == r["n"] * (r["n"] + 1) // 2 for r in places)
