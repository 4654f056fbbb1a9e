"""Change capture and dimension history under random replays."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from martloom.operators import changes, dimensions, facts, keys, quality, versions
from martloom.plans import marts

ROW = "id string, name string, qty int"


def _snapshot(rng):
    return {f"k{i}": (rng.choice(["a", "b", None]), rng.choice([1, 2, None])) for i in range(12) if rng.random() < 0.7}


def _frame(spark, rows):
    return spark.createDataFrame([(k, *v) for k, v in rows.items()], ROW)


@pytest.mark.parametrize("seed", range(6))
def test_diff_applied_to_old_gives_new(spark, seed):
    rng = random.Random(seed)
    old, new = _snapshot(rng), _snapshot(rng)
    before, after = _frame(spark, old), _frame(spark, new)
    found = changes.diff(before, after, ["id"])
    assert sorted(map(str, changes.apply(before, found, ["id"]).collect())) == sorted(map(str, after.collect()))
    counts = changes.summary(found, "x").first()
    assert counts["inserts"] == len(new.keys() - old.keys())
    assert counts["deletes"] == len(old.keys() - new.keys())
    assert counts["updates"] == sum(1 for k in old.keys() & new.keys() if old[k] != new[k])


def test_diff_skips_null_keys_and_compares_variants(spark):
    old = spark.createDataFrame([("a", '{"x":1,"y":2}'), (None, "{}")], "id string, t string")
    new = spark.createDataFrame([("a", '{"y":2,"x":1}'), (None, "[]")], "id string, t string")
    parse = [F.col("id"), F.parse_json("t").alias("doc")]
    assert changes.diff(old.select(*parse), new.select(*parse), ["id"]).count() == 0


DIMENSION = ("sk bigint, id string, name string, h string, effective_date date, end_date date, is_current boolean")


def _load(spark, dimension, rows, day):
    source = spark.createDataFrame(rows, "id string, name string, seq int").withColumn("h", F.md5(
        F.coalesce("name", F.lit(""))))
    loaded = dimensions.scd2_load(dimension, source, "id", "h", day, "sk", [F.desc("seq")], slices=4)
    return spark.createDataFrame(loaded.collect(), DIMENSION)


@pytest.mark.parametrize("seed", range(4))
def test_scd2_invariants(spark, seed):
    rng = random.Random(seed)
    dimension, truth, day = spark.createDataFrame([], DIMENSION), {}, dt.date(2024, 1, 1)
    for _batch in range(5):
        rows = [(f"k{rng.randint(0, 5)}", rng.choice(["a", "b", "c", None]), i) for i in range(rng.randint(1, 8))]
        dimension = _load(spark, dimension, rows, day)
        truth |= {i: n for i, n, _ in rows}
        found = dimension.collect()
        current = [r for r in found if r["is_current"]]
        assert {r["id"]: r["name"] for r in current} == truth and len(current) == len(truth)
        assert len({r["sk"] for r in found}) == len(found)
        assert all(r["end_date"] is None for r in current)
        assert all(r["end_date"] >= r["effective_date"] for r in found if not r["is_current"])
        assert quality.scd2_gaps(dimension, "id").count() == 0
        again = _load(spark, dimension, [(i, n, 0) for i, n in truth.items()], day)
        assert sorted(map(str, again.collect())) == sorted(map(str, found))
        day += dt.timedelta(days=rng.randint(0, 2))


def test_scd2_same_day_change_overwrites(spark):
    day = dt.date(2024, 1, 1)
    dimension = _load(spark, spark.createDataFrame([], DIMENSION), [("k", "a", 1)], day)
    dimension = _load(spark, dimension, [("k", "b", 1)], day)
    assert [(r["name"], r["effective_date"], r["is_current"]) for r in dimension.collect()] == [("b", day, True)]


def test_broadcast_only_under_the_threshold(spark, folder):
    spark.range(5_000).write.parquet(f"{folder}/ids")
    df = spark.read.parquet(f"{folder}/ids")
    size = keys.source_bytes(df)
    hinted = lambda: "broadcast" in keys.small_side(df)._jdf.queryExecution().analyzed().toString().lower()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    try:
        for limit, expected in ((str(size * keys.UNPACKED), True), (str(size * keys.UNPACKED - 1), False), ("-1", False), ("1m", True)):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            assert hinted() == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


VERSION = "id string, name string, effective_date date, end_date date"


def _versions(rng, key, n):
    """Versions one after the other, some with a gap before, some that end before they begin, the last one open."""
    day, out = dt.date(2024, 1, 1), []
    for i in range(n):
        day += dt.timedelta(days=rng.choice([0, 0, 3]))
        end = day + dt.timedelta(days=rng.choice([-1, 0, 2, 5]))
        out.append((key, f"{key}{i}", day, end))
        day = max(day, end + dt.timedelta(days=1))
    return [*out, (key, f"{key}-", day, None)]


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("limit", [25, 10_000])
def test_point_in_time_merged_equals_the_join(spark, seed, limit):
    rng = random.Random(seed)
    dimension = spark.createDataFrame([v for k in "abcd" for v in _versions(rng, k, rng.randrange(12))], VERSION)
    days = [None, dt.date(2024, 1, 9), *[dt.date(2023, 12, 28) + dt.timedelta(days=i) for i in range(40)]]
    rows = [(i, rng.choice(["a", "a", "a", "b", "c", "e", None]), days[1] if rng.random() < 0.4 else rng.choice(days))
            for i in range(500)]
    given = spark.createDataFrame(rows, "n int, id string, d date")
    plain = dimensions.point_in_time(given, dimension, "id", "d", ["name"])
    merged = dimensions.point_in_time_merged(given, dimension, "id", "d", ["name"], limit=limit)
    assert merged.columns == plain.columns
    assert sorted(map(str, merged.collect())) == sorted(map(str, plain.collect()))


def test_point_in_time_merged_with_many_versions_of_a_key(spark):
    first = F.lit("2000-01-01").cast("date")
    dimension = spark.range(10_000).select(
        F.lit("a").alias("id"), F.col("id").alias("version"), F.date_add(first, F.col("id").cast("int")).alias("effective_date"),
        F.date_add(first, F.col("id").cast("int")).alias("end_date"))
    rows = spark.range(5_000).select(F.col("id").alias("n"), F.lit("a").alias("id"), F.date_add(first, (2 * F.col("id")).cast("int")).alias("d"))
    found = dimensions.point_in_time_merged(rows, dimension, "id", "d", ["version"], limit=1_000)
    assert found.count() == 5_000 and found.filter(F.col("version") != 2 * F.col("n")).count() == 0
    whole = dimensions.point_in_time_merged(rows, dimension, "id", "d", ["version"])
    assert "Join" not in whole._jdf.queryExecution().optimizedPlan().toString()
    for a, b in ((rows.limit(0), dimension), (rows, dimension.limit(0)), (rows.limit(0), dimension.limit(0))):
        out = dimensions.point_in_time_merged(a, b, "id", "d", ["version"])
        assert out.count() == a.count() and out.filter("version IS NOT NULL").count() == 0


def test_point_in_time_and_totals_by_all_versions(spark):
    day = dt.date(2024, 1, 1)
    dimension = _load(spark, spark.createDataFrame([], DIMENSION), [("k", "a", 1)], day)
    dimension = _load(spark, dimension, [("k", "b", 1)], dt.date(2024, 1, 10))
    rows = spark.createDataFrame([("k", dt.date(2024, 1, 9)), ("k", dt.date(2024, 1, 10)), ("k", dt.date(2023, 1, 1))],
                                 "id string, d date")
    found = dimensions.point_in_time(rows, dimension, "id", "d", ["name"]).collect()
    assert {r["d"].isoformat(): r["name"] for r in found} == {"2024-01-09": "a", "2024-01-10": "b", "2023-01-01": None}

    # Facts keep the key they were loaded with: by key the total restarts, by id it does not.
    old_key, new_key = [r["sk"] for r in dimension.orderBy("effective_date").collect()]
    customer = dimension.select(F.col("sk").alias("customer_key"), F.col("id").alias("customer_id"), "is_current")
    fact = spark.createDataFrame([(old_key, 20240105, 1, 2, 10.0), (new_key, 20240111, 2, 1, 5.0)],
                                 "customer_key bigint, date_key int, order_id int, quantity int, net_amount double")
    calendar = spark.createDataFrame([(20240105, dt.date(2024, 1, 5)), (20240111, dt.date(2024, 1, 11))],
                                     "date_key int, full_date date")
    fact = fact.withColumn("net_amount", F.col("net_amount").cast("decimal(12,2)"))
    by_key = marts.with_activity(customer, fact, calendar).first()
    by_id = marts.with_activity(customer, fact, calendar, by="customer_id").first()
    assert (by_key["total_orders"], float(by_key["lifetime_value"])) == (1, 5.0)
    assert (by_id["total_orders"], float(by_id["lifetime_value"])) == (2, 15.0)


def test_merge_keeps_unset_columns(spark):
    target = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "id string, qty int, note string")
    source = spark.createDataFrame([("a", 9), ("c", 3), ("c", 4)], "id string, qty int")
    found = dimensions.overwrite_merge(target, source, ["id"], ["qty"], order=[F.desc("qty")]).collect()
    assert sorted(map(tuple, found), key=str) == [("a", 9, "x"), ("b", 2, "y"), ("c", 4, None)]


def test_product_margin_guard(spark):
    target = spark.createDataFrame([], "product_key bigint, product_id string, unit_price decimal(10,2), "
                                       "unit_cost decimal(10,2), profit_margin decimal(5,2)")
    source = spark.createDataFrame([("P1", "0.00", "3.00"), ("P2", "24.99", "35.00")], "product_id string, p string, c string")
    source = source.select("product_id", F.col("p").cast("decimal(10,2)").alias("unit_price"),
                           F.col("c").cast("decimal(10,2)").alias("unit_cost"))
    rows = {r["product_id"]: r for r in dimensions.load_product(target, source, [F.asc("unit_cost")]).collect()}
    assert float(rows["P1"]["profit_margin"]) == 0 and float(rows["P2"]["profit_margin"]) == -40.06
    assert rows["P1"]["product_key"] != rows["P2"]["product_key"]


def test_fact_load_sends_unknown_dates_to_rejects(spark):
    staged = spark.createDataFrame(
        [("O1", 1, "C1", "P1", "S1", dt.datetime(2024, 1, 1, 9), 3, "10.00", "12.50", "26.25", True),
         ("O2", 1, "C9", "P9", "S9", dt.datetime(2024, 1, 1, 9), 1, "1.00", "0.00", "1.00", True),
         ("O3", 1, "C1", "P1", "S1", dt.datetime(1999, 1, 1), 1, "1.00", "0.00", "1.00", True),
         ("O4", 1, "C1", "P1", "S1", dt.datetime(2024, 1, 1), 1, "1.00", "0.00", "1.00", False)],
        "order_id string, order_line_id int, customer_id string, product_id string, store_id string, "
        "transaction_date timestamp_ntz, quantity int, unit_price string, discount_percent string, "
        "total_amount string, dq_is_valid boolean")
    staged = staged.withColumns({c: F.col(c).cast(t) for c, t in (
        ("unit_price", "decimal(10,2)"), ("discount_percent", "decimal(5,2)"), ("total_amount", "decimal(12,2)"))})
    staged = staged.withColumns({c: F.lit("x") for c in ("payment_method", "order_status", "source_file")})
    calendar = spark.createDataFrame([(20240101, dt.date(2024, 1, 1))], "date_key int, full_date date")
    customer = spark.createDataFrame([(1, "C1", True), (2, "C9", False)],
                                     "customer_key bigint, customer_id string, is_current boolean")
    product = spark.createDataFrame([(5, "P1")], "product_key bigint, product_id string")
    store = spark.createDataFrame([(7, "S1")], "store_key bigint, store_id string")
    fact, rejected = facts.load_sales(staged, calendar, customer, product, store, unknown=dimensions.UNKNOWN_KEY)
    rows = {r["order_id"]: r for r in fact.collect()}
    assert set(rows) == {"O1", "O2"} and [r["order_id"] for r in rejected.collect()] == ["O3"]
    assert float(rows["O1"]["discount_amount"]) == 3.75 and float(rows["O1"]["gross_amount"]) == 30.0
    assert (rows["O2"]["customer_key"], rows["O2"]["product_key"], rows["O2"]["store_key"]) == (-1, -1, -1)


def test_keys_are_unique_and_repeatable(spark):
    df = spark.range(5000).select(F.concat(F.lit("n"), "id").alias("n"))
    first = keys.add_keys(df, "sk", "n", 100, 16)
    assert first.select("sk").distinct().count() == 5000 and first.filter("sk <= 100").count() == 0
    again = keys.add_keys(df.repartition(7), "sk", "n", 100, 16)
    assert first.exceptAll(again).count() == 0


def test_not_in_with_null_among_the_unwanted(spark):
    rows = spark.createDataFrame([("a",), ("b",), (None,)], "id string")
    unwanted = spark.createDataFrame([("a",), (None,)], "id string")
    assert [r["id"] for r in keys.not_in(rows, unwanted, "id").collect()] == ["b"]


def test_restore(spark):
    old = spark.createDataFrame([("a", "x", 1), ("b", "y", 1)], ROW)
    new = spark.createDataFrame([("a", "z", 2), ("c", "y", 1)], ROW)
    assert [r["id"] for r in versions.deleted(old, new, ["id"]).collect()] == ["b"]
    assert [r["id"] for r in versions.added(old, new, ["id"]).collect()] == ["c"]
    assert sorted(r["id"] for r in versions.restore_deleted(old, new, ["id"]).collect()) == ["a", "b", "c"]


def test_digests_find_the_buckets_that_changed(spark):
    from martloom.operators import changes

    schema = "k string, v double, w string"
    rows = [(f"k{i}" if i % 3 else None, float(i), None if i % 5 else "w") for i in range(3000)]
    old = spark.createDataFrame(rows, schema)
    assert changes.changed_buckets(old, old.repartition(5), ["k"], 64) == []
    plan = changes.diff_by_digest(old, old, ["k"], 64)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    touched = [("k1", 1.0, "other") if r[0] == "k1" else r for r in rows if r[0] != "k2"] + [("new", None, None)]
    new = spark.createDataFrame(touched, schema)
    assert 1 <= len(changes.changed_buckets(old, new, ["k"], 64)) <= 3
    text = lambda df: sorted(map(str, df.collect()))
    assert text(changes.diff_by_digest(old, new, ["k"], 64)) == text(changes.diff(old, new, ["k"]))
    assert text(changes.diff_by_digest(old, new, ["k"], 1)) == text(changes.diff(old, new, ["k"]))
    assert changes.diff_by_digest(old.limit(0), old.limit(0), ["k"]).count() == 0
