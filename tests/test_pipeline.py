"""Two batches from landing files to marts."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from martloom.operators import calendar
from martloom.plans import marts, pipeline
from martloom.schemas import RAW_CUSTOMERS, RAW_INVENTORY, RAW_SALES
from martloom.sources import sinks

DAYS = (dt.date(2024, 1, 1), 60)


def _names(schema):
    return [c.split()[0] for c in schema.split(", ")]


def _write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def _customer(i, segment):
    return (f"C{i}, ann ,lee,ANN{i}@X.COM,555-010{i},1990-05-17,f,2023-01-0{i},{segment},1 Main St,austin,tx,73301,usa,"
            f"{i * 10000},email,true")


def _sale(order, line, customer, quantity, price, discount, day):
    total = round(quantity * price * (100 - discount) / 100, 2)
    return f"{order},{line},{customer},P1,STORE-001,{day} 10:00:00,{quantity},{price},{discount},{total},cash,completed"


def test_two_batches(spark, folder):
    layers = pipeline.Layers(folder)
    days = calendar.dim_date(spark, *DAYS, as_of=dt.date(2024, 1, 20))
    _write(layers.landing("customers/a.csv"), [",".join(_names(RAW_CUSTOMERS)), _customer(1, "vip"), _customer(2, "basic")])
    _write(layers.landing("products/a.json"), [json.dumps({
        "product_id": "P1", "product_name": "Lamp", "category": "Home", "unit_cost": 6, "unit_price": 10,
        "is_active": True, "launch_date": "2023-05-01", "attributes": {"color": "red", "sizes": [1, 2]}})])
    _write(layers.landing("sales/a.csv"), [",".join(_names(RAW_SALES)),
           _sale("O1", 1, "C1", 2, 10.0, 10, "2024-01-15"), _sale("O2", 1, "C2", 1, 10.0, 0, "2024-01-16"),
           _sale("O3", 1, "C1", 0, 10.0, 0, "2024-01-16"), _sale("O4", 1, "C1", 1, 10.0, 0, "2030-01-01")])
    click = {"event_id": "e1", "session_id": "s1", "customer_id": "C1", "event_timestamp": "2024-01-15T10:00:00.000Z",
             "event_type": "page_view"}
    _write(layers.landing("clickstream/a.json"), [json.dumps(click), json.dumps(click), json.dumps(click | {
        "event_id": "e2", "customer_id": None})])
    now = dt.datetime(2024, 1, 20, 6)
    assert pipeline.run_batch(spark, layers, 1, days, now) == {
        "sales": 4, "customers": 2, "products": 1, "clickstream": 3}
    fact = sinks.get_batch(spark, layers.curated("fact_sales"))
    rows = {r["order_id"]: r for r in fact.collect()}
    assert set(rows) == {"O1", "O2"} and float(rows["O1"]["net_amount"]) == 18.0
    assert float(rows["O1"]["discount_amount"]) == 2.0
    assert spark.read.parquet(f"{layers.staging('sales_rejected_dates')}/batch=1").count() == 1
    clicks = {r["event_id"]: r for r in sinks.get_batch(spark, layers.curated("fact_clickstream")).collect()}
    assert set(clicks) == {"e1", "e2"} and clicks["e1"]["customer_key"] and clicks["e2"]["customer_key"] is None
    product = sinks.get_batch(spark, layers.curated("dim_product")).first()
    assert float(product["profit_margin"]) == 40.0

    # Nothing new: nothing happens.
    assert not any(pipeline.run_batch(spark, layers, 2, days, now).values())

    # A changed customer, a late sale, and a sale for the changed customer.
    _write(layers.landing("customers/b.csv"), [",".join(_names(RAW_CUSTOMERS)), _customer(1, "premium")])
    _write(layers.landing("sales/b.csv"), [",".join(_names(RAW_SALES)),
           _sale("O5", 1, "C1", 3, 10.0, 0, "2024-01-02"), _sale("O2", 1, "C2", 5, 10.0, 0, "2024-01-16")])
    later = dt.datetime(2024, 1, 21, 6)
    pipeline.run_batch(spark, layers, 3, days, later)
    versions = sinks.get_batch(spark, layers.curated("dim_customer")).filter("customer_id = 'C1'")
    found = [(r["customer_segment"], r["effective_date"].day, r["end_date"] and r["end_date"].day, r["is_current"])
             for r in versions.orderBy("effective_date").collect()]
    assert found == [("VIP", 20, 20, False), ("PREMIUM", 21, None, True)]
    fact = sinks.get_batch(spark, layers.curated("fact_sales"))
    assert {r["order_id"]: r["quantity"] for r in fact.collect()} == {"O1": 2, "O2": 5, "O5": 3}
    mart = sinks.get_batch(spark, layers.analytics("agg_daily_sales"))
    assert float(mart.agg(F.sum("net_revenue")).first()[0]) == 98.0
    kpis = {r["kpi_name"]: r for r in pipeline.read_snapshots(spark, layers, dt.date(2024, 1, 21)).collect()}
    revenue = kpis["TOTAL_REVENUE_MTD"]
    assert (float(revenue["kpi_value"]), float(revenue["previous_value"])) == (98.0, 28.0)
    log = spark.read.parquet(layers.audit("quality_log"))
    assert log.filter("rule_name = 'FK_CUSTOMER_INTEGRITY'").select("status").distinct().first()["status"] == "PASS"
    assert pipeline.check_quality(spark, layers, 3, days, later).first()["failures"] == 0

    # The same batch again gives the same tables.
    before = sorted(map(str, fact.collect()))
    pipeline.load_facts(spark, layers, 3, days)
    assert sorted(map(str, sinks.get_batch(spark, layers.curated("fact_sales")).collect())) == before


def test_a_batch_that_died_is_loaded_by_the_next_run(spark, folder):
    days = calendar.dim_date(spark, *DAYS, as_of=dt.date(2024, 1, 20))
    now = dt.datetime(2024, 1, 20, 6)

    def land(layers, name, quantity):
        _write(layers.landing("customers/a.csv"), [",".join(_names(RAW_CUSTOMERS)), _customer(1, "vip")])
        _write(layers.landing("products/a.json"), [json.dumps({"product_id": "P1", "product_name": "Lamp", "category": "Home",
                                                               "unit_cost": 6, "unit_price": 10, "is_active": True})])
        _write(layers.landing(f"sales/{name}.csv"), [",".join(_names(RAW_SALES)), _sale(name, 1, "C1", quantity, 10.0, 0, "2024-01-15")])

    for retry in (1, 2):
        layers = pipeline.Layers(f"{folder}/{retry}")
        land(layers, "O1", 2)
        pipeline.stage(spark, layers, 1, now)
        land(layers, "O2", 3)
        pipeline.run_batch(spark, layers, retry, days, now)
        pipeline.run_batch(spark, layers, 3, days, now)
        fact = sinks.get_batch(spark, layers.curated("fact_sales"))
        assert {r["order_id"]: r["quantity"] for r in fact.collect()} == {"O1": 2, "O2": 3}
        mart = sinks.get_batch(spark, layers.analytics("agg_daily_sales"))
        assert float(mart.agg(F.sum("net_revenue")).first()[0]) == 50.0
        assert pipeline.open_batches(spark, layers) == []


def _land_dimensions(layers):
    _write(layers.landing("customers/a.csv"), [",".join(_names(RAW_CUSTOMERS)), _customer(1, "vip")])
    _write(layers.landing("products/a.json"), [json.dumps({"product_id": "P1", "product_name": "Lamp", "category": "Home",
                                                           "unit_cost": 6, "unit_price": 10, "is_active": True})])


def test_a_batch_without_sales_ends(spark, folder):
    layers = pipeline.Layers(folder)
    days = calendar.dim_date(spark, *DAYS, as_of=dt.date(2024, 1, 20))
    _land_dimensions(layers)
    pipeline.run_batch(spark, layers, 1, days, dt.datetime(2024, 1, 20, 6))
    assert pipeline.open_batches(spark, layers) == []
    _write(layers.landing("sales/a.csv"), [",".join(_names(RAW_SALES)), _sale("O1", 1, "C1", 2, 10.0, 0, "2024-01-15")])
    pipeline.run_batch(spark, layers, 2, days, dt.datetime(2024, 1, 21, 6))
    stored = sinks.get_batch(spark, layers.curated("fact_sales"))
    assert stored.count() == 1
    expected = pipeline._table(spark, pipeline.Layers(f"{folder}/none"), "fact_sales", pipeline.SALES_FACT).schema
    assert {f.name: f.dataType for f in stored.schema} == {f.name: f.dataType for f in expected}


def test_a_line_whose_date_moves_stands_once(spark, folder):
    layers = pipeline.Layers(folder)
    days = calendar.dim_date(spark, *DAYS, as_of=dt.date(2024, 1, 20))
    _land_dimensions(layers)
    header = ",".join(_names(RAW_SALES))
    _write(layers.landing("sales/a.csv"), [header, _sale("O1", 1, "C1", 2, 10.0, 0, "2024-01-15"),
                                           _sale("O2", 1, "C1", 1, 10.0, 0, "2024-02-03")])
    pipeline.run_batch(spark, layers, 1, days, dt.datetime(2024, 1, 20, 6))
    _write(layers.landing("sales/b.csv"), [header, _sale("O1", 1, "C1", 2, 10.0, 0, "2024-02-03")])
    pipeline.run_batch(spark, layers, 2, days, dt.datetime(2024, 2, 4, 6))
    for _again in range(2):
        fact = sinks.get_batch(spark, layers.curated("fact_sales"))
        assert {(r["order_id"], r["date_key"]) for r in fact.collect()} == {("O1", 20240203), ("O2", 20240203)}
        assert fact.count() == 2
        pipeline.load_facts(spark, layers, 2, days)
    mart = sinks.get_batch(spark, layers.analytics("agg_daily_sales"))
    assert float(mart.agg(F.sum("net_revenue")).first()[0]) == 30.0


def _same(left, right):
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    text = lambda df: sorted(str([None if v is None else float(v) if hasattr(v, "as_tuple") else v for v in r])
                             for r in df.select(columns).collect())
    assert text(left) == text(right)


def test_refreshed_marts_equal_marts_computed_anew(spark, folder):
    """Sales that come, move and change price, customers that change segment; each batch against a full computation."""
    layers = pipeline.Layers(folder)
    days = calendar.dim_date(spark, *DAYS, as_of=dt.date(2024, 1, 20))
    header = ",".join(_names(RAW_SALES))
    _write(layers.landing("products/a.json"), [json.dumps({"product_id": "P1", "product_name": "Lamp", "category": "Home",
                                                           "unit_cost": 6, "unit_price": 10, "is_active": True})])
    people = [[_customer(1, "vip"), _customer(2, "basic"), _customer(3, "basic")], [_customer(1, "premium")], []]
    sales = [
        [_sale(f"O{i}", line, f"C{i % 4}", i, 10.0, 0, f"2024-0{1 + i % 2}-{10 + i % 5}") for i in range(1, 9) for line in (1, 2)],
        [_sale("O1", 1, "C1", 1, 10.0, 0, "2024-01-12"), _sale("O2", 1, "C1", 9, 10.0, 0, "2024-01-28")],
        [_sale("O2", 1, "C2", 9, 10.0, 0, "2024-02-28"), _sale("O99", 1, "C1", 2, 10.0, 0, "2024-02-13")],
    ]
    for n, (customers, lines) in enumerate(zip(people, sales), 1):
        if customers:
            _write(layers.landing(f"customers/{n}.csv"), [",".join(_names(RAW_CUSTOMERS)), *customers])
        _write(layers.landing(f"sales/{n}.csv"), [header, *lines])
        now = dt.datetime(2024, 1, 20 + n, 6)
        pipeline.run_batch(spark, layers, n, days, now)
        fact = sinks.get_batch(spark, layers.curated("fact_sales"))
        customer, product, store = (sinks.get_batch(spark, layers.curated(f"dim_{d}")) for d in ("customer", "product", "store"))
        _same(sinks.get_batch(spark, layers.analytics("agg_daily_sales")), marts.daily_sales(fact, days, store, product, customer))
        _same(sinks.get_batch(spark, layers.analytics("agg_monthly_sales")), marts.monthly_sales(fact, days, store, product))
        _same(sinks.get_batch(spark, layers.analytics("customer_360")), marts.customer_360(customer, fact, days, now.date()))
    # The last batch has moved a line from January to February: the days of other lines keep their groups.
    written = {r["part"]: r["version"] for r in spark.read.json(f"{layers.analytics('daily_groups')}/_commits/batch=*").groupBy(
        "part").agg(F.max("version").alias("version")).collect()}
    assert written == {"202401": 3, "202402": 3}
    totals = spark.read.json(f"{layers.curated('customer_totals')}/_commits/batch=*").groupBy("version").count().collect()
    assert {r["version"]: r["count"] for r in totals}[3] <= 2


def test_stock_counts_and_rejected_events(spark, folder):
    layers = pipeline.Layers(folder)
    days = calendar.dim_date(spark, *DAYS, as_of=dt.date(2024, 1, 20))
    _land_dimensions(layers)
    header = ",".join(_names(RAW_INVENTORY))
    _write(layers.landing("inventory/a.csv"), [
        header, "I1,P1,STORE-001,20,5,10,50,2024-01-02,2024-01-15 10:00:00", "I2,P1,STORE-001,12,5,10,50,2024-01-02,2024-01-16 10:00:00",
        "I3,P1,STORE-002,x,0,10,50,,2024-01-15 10:00:00", "I4,P9,STORE-002,-1,0,10,50,,2024-01-15 10:00:00",
        "I5,,STORE-002,1,0,10,50,,2024-01-15 10:00:00"])
    _write(layers.landing("clickstream/a.json"), [json.dumps({"event_id": "e1", "session_id": "s"})])
    pipeline.run_batch(spark, layers, 1, days, dt.datetime(2024, 1, 20, 6))
    position = {r["store_key"]: r for r in sinks.get_batch(spark, layers.analytics("inventory_position")).collect()}
    assert len(position) == 2 and sorted((r["quantity_on_hand"], r["needs_reorder"]) for r in position.values() if r["quantity_on_hand"]) == [(12, True)]
    assert spark.read.parquet(f"{layers.staging('inventory_rejected')}/batch=1").count() == 2
    assert spark.read.parquet(f"{layers.staging('clickstream_rejected_events')}/batch=1").count() == 1
    # A corrected count, moved to the next month, replaces the first.
    _write(layers.landing("inventory/b.csv"), [header, "I2,P1,STORE-001,40,5,10,50,2024-01-02,2024-02-16 10:00:00"])
    pipeline.run_batch(spark, layers, 2, days, dt.datetime(2024, 1, 21, 6))
    stored = sinks.get_batch(spark, layers.curated("fact_inventory"))
    assert {(r["inventory_id"], r["month"]) for r in stored.collect()} == {("I1", 202401), ("I2", 202402), ("I3", 202401)}


def test_a_run_leaves_no_shuffle_files_and_nothing_that_no_step_reads(spark, folder):
    import time
    from pathlib import Path

    import duckdb

    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name.split("_")[1] for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}

    scratch = lambda: set(Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:")).glob("*/*"))
    layers = pipeline.Layers(folder)
    days = calendar.dim_date(spark, *DAYS, as_of=dt.date(2024, 1, 20))
    before, held = shuffled(), scratch()
    for batch in (1, 2):
        _land_dimensions(layers)
        _write(layers.landing(f"sales/{batch}.csv"), [",".join(_names(RAW_SALES)), *[
            _sale(f"O{i}", 1, "C1", batch, 10.0, 0, f"2024-01-{i:02}") for i in range(batch, batch + 9)]])
        assert pipeline.run_batch(spark, layers, batch, days, dt.datetime(2024, 1, 20, 6))["sales"] == 9
    assert sinks.get_batch(spark, layers.curated("fact_sales")).agg(F.sum("quantity")).first()[0] == 19
    assert scratch() == held
    until = time.time() + 20
    # A stage that its query did not wait for may end after it.
    while len(shuffled() - before) > 3 and time.time() < until:
        time.sleep(0.1)
    assert len(shuffled() - before) <= 3
    for table in (layers.curated("fact_sales"), layers.analytics("agg_daily_sales"), f"{layers.staging('sales')}/batch=1"):
        codecs = duckdb.sql(f"SELECT DISTINCT compression FROM parquet_metadata('{table}/**/*.parquet')").fetchall()
        assert codecs == [("ZSTD",)]


def test_landed_sales_are_zipped_and_numbered(spark):
    from martloom.catalog import batch
    from martloom.plans.star import Star
    from martloom.session import scratch_path
    from martloom.sources import files

    s = Star(spark, "/root/testdata/sf0.001")
    layers = pipeline.Layers(scratch_path(spark, "landed"))
    lines = batch._lines(s)
    batch._land_sales(s, layers, lines)
    assert all(name.endswith(".csv.gz") for name in os.listdir(layers.landing("sales").removeprefix("file:"))
               if name.startswith("part-"))
    read = files.read_delimited(spark, layers.landing("sales"), RAW_SALES)
    names = _names(RAW_SALES)
    sent = lines.select(*[F.col(c).cast("string") for c in names])
    assert sorted(map(str, read.select(*names).collect())) == sorted(map(str, sent.collect()))
    places = read.groupBy("_source_file").agg(F.count("*").alias("n"), F.sum("_file_row_number").alias("s"))
    assert all(r["s"] == r["n"] * (r["n"] + 1) // 2 for r in places.collect())
