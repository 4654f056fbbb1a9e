"""Dimensions kept in buckets: what a batch rewrites, and the keys it gives."""

import datetime as dt

from pyspark.sql import functions as F

from martloom.sources import buckets, sinks
from martloom.streaming import ingest, tables

SCHEMA = "id string, name string, h string"
FULL = "k bigint, id string, name string, h string, effective_date date, end_date date, is_current boolean"


def _versions(spark, base):
    known = spark.read.schema(sinks.BATCH_COMMIT_SCHEMA).json(f"{base}/_commits/batch=*")
    return {v: sorted(r["part"] for r in known.filter(F.col("version") == v).collect()) for v in
            [r[0] for r in known.select("version").distinct().collect()]}


def _initial(spark, n):
    start = dt.date(2024, 1, 1)
    return spark.createDataFrame([(i * 3, f"c{i}", f"n{i}", f"h{i}", start, None, True) for i in range(n)], FULL)


def _feed(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")


def _scd2(spark, folder, initial):
    changes = ingest.source(spark, f"{folder}/in", SCHEMA)
    tables.keep_scd2(changes, f"{folder}/dim", initial, "id", "h", "k", lambda n: dt.date(2024, 2, 1 + n), [F.asc("name")],
                     f"{folder}/checkpoint").awaitTermination()
    return sinks.get_batch(spark, f"{folder}/dim")


def test_one_changed_customer_rewrites_one_bucket(spark, folder):
    initial = _initial(spark, 300)
    _feed(spark, folder, [("c1", "n1", "h1")])
    assert _scd2(spark, folder, initial).count() == 300
    _feed(spark, folder, [("c7", "new name", "h7b")])
    found = _scd2(spark, folder, initial)
    versions = _versions(spark, f"{folder}/dim")
    assert len(versions[0]) == buckets.BUCKETS and len(versions[1]) == 1
    assert found.count() == 301
    rows = {(r["is_current"], r["effective_date"].month): r for r in found.filter("id = 'c7'").collect()}
    assert rows[False, 1]["end_date"] == dt.date(2024, 2, 1) and rows[True, 2]["name"] == "new name"


def test_new_keys_are_unique_over_batches_and_repeat(spark, folder):
    initial = _initial(spark, 50)
    for step in range(3):
        _feed(spark, folder, [(f"x{step}-{i}", "n", "h") for i in range(100)] + [(f"c{i}", "n", f"h{step}") for i in range(20)]
              + [(None, "lost", "h")])
        found = _scd2(spark, folder, initial)
    keys = [r["k"] for r in found.collect()]
    assert len(set(keys)) == len(keys) == 50 + 300 + 59
    assert found.filter("is_current").select("id").distinct().count() == found.filter("is_current").count() == 350
    changes = spark.createDataFrame([(f"x2-{i}", "n", "h") for i in range(100)], SCHEMA)
    first = buckets.first_key(f"{folder}/dim", initial, "k")
    assert first == 147
    known = sinks.get_batch(spark, f"{folder}/dim", before=2).drop("_bucket")
    again = {r["id"]: r["k"] for r in buckets.add_keys(changes, known, "k", "id", first).collect()}
    stored = {r["id"]: r["k"] for r in found.filter("id LIKE 'x2%'").collect()}
    assert set(again.values()) & {r["k"] for r in known.collect()} == set() and len(again) == len(stored)


def test_overwriting_dimension_with_empty_and_null_batches(spark, folder):
    initial = spark.createDataFrame([(f"c{i}", f"n{i}", "h") for i in range(100)], SCHEMA)
    merge = lambda t, r: t.join(r, "id", "left_anti").unionByName(r)
    put = lambda rows, v: buckets.merge_buckets(spark.createDataFrame(rows, SCHEMA), folder, ["id"], initial, merge, v)
    assert len(put([], 0)) == buckets.BUCKETS
    assert put([], 1) == []
    assert len(put([("c5", "changed", "h")], 2)) == 1
    assert len(put([(None, "nameless", "h")], 3)) == 1
    stored = sinks.get_batch(spark, folder)
    assert stored.count() == 101 and stored.filter("name = 'changed'").count() == 1
