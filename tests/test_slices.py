"""Windows over hot keys against a plain window and brute force."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from martloom.operators import percentiles, slices


def _rows(seed):
    rng = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    out = []
    for i in range(600):
        user = 1 if rng.random() < 0.5 else rng.randint(2, 30)
        amount = 100 if rng.random() < 0.4 else rng.randint(1, 60)
        out.append((i, user, base + dt.timedelta(minutes=rng.randint(0, 3000)), amount, rng.choice("abc")))
    return out


SCHEMA = "id bigint, user bigint, ts timestamp_ntz, amount int, kind string"


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("limit", [20, 10_000])
def test_rank_descending(spark, seed, limit):
    df = spark.createDataFrame(_rows(seed), SCHEMA)
    found = slices.rank_descending(df, ["user"], "amount", ["id"], "rank", limit=limit, parts=8)
    plain = df.withColumn("rank", F.row_number().over(Window.partitionBy("user").orderBy(F.desc("amount"), "id")))
    columns = ["id", "rank"]
    assert sorted(map(tuple, found.select(*columns).collect())) == sorted(map(tuple, plain.select(*columns).collect()))


def test_hot_key_is_cut_even_if_one_value_fills_it(spark):
    df = spark.range(1000).select(F.col("id"), F.lit(1).alias("user"), F.lit(5).alias("amount"))
    cut = slices.slice_hot_with_ties(df, ["user"], F.col("amount"), F.col("id"), limit=100, parts=8)
    sizes = [r["count"] for r in cut.groupBy("_slice").count().collect()]
    assert len(sizes) >= 7 and max(sizes) < 300
    ranked = slices.rank_descending(df, ["user"], "amount", ["id"], "rank", limit=100, parts=8)
    assert ranked.filter(F.col("rank") != F.col("id") + 1).count() == 0


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("limit", [20, 10_000])
def test_sessions_and_changes(spark, seed, limit):
    rows = _rows(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    found = slices.sessionize(df, "user", "ts", "id", 30, limit=limit, parts=8)
    found = slices.change_count(found, "user", "ts", "id", "kind", limit=limit, parts=8)
    expected = {}
    for _user, group in pd.DataFrame(rows, columns=["id", "user", "ts", "amount", "kind"]).groupby("user"):
        session = changes = 0
        before = None
        for r in group.sort_values(["ts", "id"]).itertuples():
            gap = None if before is None else (
                r.ts.replace(second=0) - before.ts.replace(second=0)).total_seconds() / 60
            session += gap is None or gap > 30
            changes += before is not None and before.kind != r.kind
            expected[r.id] = (session, changes)
            before = r
    assert {r["id"]: (r["session_number"], r["change_number"]) for r in found.collect()} == expected


def test_hot_null_key_is_cut_and_kept_together(spark):
    df = spark.range(1000).select("id", F.lit(None).cast("bigint").alias("user"), (F.col("id") % 7).cast("int").alias("amount"),
                                  F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz").alias("ts"), F.lit("a").alias("kind"))
    cut = slices.slice_hot(df, ["user"], F.col("id"), limit=100)
    sizes = [r["count"] for r in cut.groupBy("_slice").count().collect()]
    assert len(sizes) >= 10 and max(sizes) <= 130
    ranked = slices.rank_descending(df, ["user"], "amount", ["id"], "rank", limit=100)
    assert sorted(r["rank"] for r in ranked.collect()) == list(range(1, 1001))
    assert slices.sessionize(df, "user", "ts", "id", 30, limit=100).agg(F.max("session_number")).first()[0] == 1


def test_running_total_shares_ties(spark):
    df = spark.createDataFrame([(1, 1, 5), (1, 1, 6), (1, 2, 7), (2, 1, 1)], "k int, d int, v int")
    found = slices.running_total(df, ["k"], "d", "v", "t").collect()
    assert sorted((r["k"], r["d"], r["t"]) for r in found) == [(1, 1, 11), (1, 1, 11), (1, 2, 18), (2, 1, 1)]


@pytest.mark.parametrize("fraction", [0.0, 0.25, 0.5, 0.95, 1.0])
def test_exact_percentile(spark, monkeypatch, fraction):
    monkeypatch.setattr(percentiles, "ACCURACY", 100)
    monkeypatch.setattr(percentiles, "SLACK", 0.1)
    rng = random.Random(7)
    rows = [(i % 3, rng.choice([7, rng.randint(0, 100000)])) for i in range(3000)] + [(9, 4), (9, 5), (8, None)]
    df = spark.createDataFrame(rows, "k int, v int")
    found = {r["k"]: r["p"] for r in percentiles.exact_percentile(df, ["k"], "v", fraction, "p").collect()}
    frame = pd.DataFrame(rows, columns=["k", "v"]).dropna()
    expected = frame.groupby("k")["v"].quantile(fraction).to_dict()
    assert found.keys() == expected.keys()
    assert all(abs(found[k] - expected[k]) < 1e-6 for k in expected)
    everything = percentiles.exact_percentile(df, [], "v", fraction, "p").first()["p"]
    assert abs(everything - frame["v"].quantile(fraction)) < 1e-6


def test_percentiles_at_once_equal_numpy_on_hot_values_and_keys(spark):
    import numpy as np

    from martloom.operators.percentiles import exact_percentiles

    rng = np.random.default_rng(4)
    rows = [("hot", 7.0) for _ in range(18000)] + [("hot", float(v)) for v in rng.normal(0, 50, 2000)]
    rows += [(None, float(v)) for v in rng.integers(0, 5, 900)] + [("one", 3.0), ("none", None), ("two", 1.0), ("two", 2.0)]
    wanted = {"a": 0.0, "b": 0.5, "c": 0.95, "d": 0.99, "e": 1.0, "f": 0.05}
    frame = spark.createDataFrame(rows, "k string, v double")
    got = {r["k"]: r for r in exact_percentiles(frame, ["k"], "v", wanted, slices=16).collect()}
    assert set(got) == {"hot", None, "one", "two"}
    for key, row in got.items():
        values = [v for k, v in rows if k == key]
        for name, fraction in wanted.items():
            assert abs(row[name] - np.quantile(values, fraction)) < 1e-9, (key, name)
    assert exact_percentiles(frame.limit(0), ["k"], "v", wanted).count() == 0
    plan = lambda names: exact_percentiles(frame, ["k"], "v", {n: wanted[n] for n in names})._jdf.queryExecution().executedPlan().toString()
    assert plan("abcdef").count("Exchange") == plan("b").count("Exchange")
