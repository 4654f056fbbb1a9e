"""Loads from a stream of files: once each, by size, with line numbers of rejected rows."""

import datetime as dt
import json
import os

import pytest

from martloom.schemas import RAW_SALES
from martloom.sources import feed, files, loading

NOW = dt.datetime(2024, 1, 1)


def _write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def _product(name, cost):
    return json.dumps({"product_id": name, "unit_cost": cost})


def _load(spark, folder, clean=loading.clean_products, now=lambda: NOW, **options):
    stream = feed.json_lines(spark, f"{folder}/in", most_bytes=options.pop("most_bytes", None))
    feed.load(stream, f"{folder}/out", f"{folder}/checkpoint", clean, now, **options).awaitTermination()


def test_lines_of_rejected_rows_in_files_of_several_splits(spark, folder):
    lines = [_product(f"p{i}", "x" if i % 7 == 3 else i) for i in range(4000)]
    _write(f"{folder}/in/a.json", lines)
    _write(f"{folder}/in/b.json", ["not a document", *lines[:5]])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        _load(spark, folder)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    bad = spark.read.parquet(f"{folder}/out_rejected").collect()
    found = {(os.path.basename(r["source_file"]), r["file_row_number"]) for r in bad}
    assert found == {("a.json", i + 1) for i in range(4000) if i % 7 == 3} | {("b.json", 1), ("b.json", 5)}
    per_file = {os.path.basename(r["source_file"]): (r["row_parsed"], r["error_count"], r["rows_loaded"])
                for r in spark.read.parquet(f"{folder}/out_files").collect()}
    assert per_file["a.json"] == (4000, 571, 3429) and per_file["b.json"] == (6, 2, 4)


def test_a_file_is_loaded_once_and_batches_keep_to_the_size(spark, folder):
    for i in range(3):
        _write(f"{folder}/in/{i}.json", [_product(f"p{i}-{k}", 1) for k in range(20)])
    _load(spark, folder, most_bytes=1)
    _load(spark, folder, most_bytes=1)
    assert spark.read.parquet(f"{folder}/out").groupBy("batch").count().collect() and spark.read.parquet(f"{folder}/out").count() == 60
    assert spark.read.parquet(f"{folder}/out").select("batch").distinct().count() == 3
    _write(f"{folder}/in/3.json", [_product("late", 1)])
    _load(spark, folder)
    assert spark.read.parquet(f"{folder}/out").count() == 61


def test_a_batch_that_died_is_loaded_again_under_its_number(spark, folder):
    _write(f"{folder}/in/a.json", [_product("p", 1), _product("q", "x")])

    def broken():
        raise RuntimeError("no clock")

    with pytest.raises(Exception, match="no clock"):
        _load(spark, folder, now=broken)
    _load(spark, folder)
    assert [r["batch"] for r in spark.read.parquet(f"{folder}/out").collect()] == [0]
    assert spark.read.parquet(f"{folder}/out_rejected").count() == 1


def test_skipped_files_and_delimited_text(spark, folder):
    _write(f"{folder}/in/a.json", [_product("p", 1), _product("q", "x")])
    _write(f"{folder}/in/b.json", [_product("r", 1)])
    _load(spark, folder, policy="SKIP_FILE")
    assert [r["product_id"] for r in spark.read.parquet(f"{folder}/out").collect()] == ["r"]
    header = ",".join(c.split()[0] for c in RAW_SALES.split(", "))
    _write(f"{folder}/csv/a.csv", [header, "O1,1,C1,P1,S1,2024-01-01 10:00:00,2,1.5,0,3.0,cash,done", "O2,NULL"])
    stream = feed.delimited(spark, f"{folder}/csv", RAW_SALES, files.CSV_STANDARD)
    feed.load(stream, f"{folder}/sales", f"{folder}/checkpoint2", loading.clean_sales, lambda: NOW).awaitTermination()
    rows = {r["order_id"]: r for r in spark.read.parquet(f"{folder}/sales").collect()}
    assert rows["O1"]["quantity"] == 2 and rows["O2"]["order_line_id"] is None and len(rows) == 2
