import datetime as dt
import gzip
import os

import pytest
from pyspark.sql import functions as F

from martloom.operators import quality
from martloom.schemas import RAW_SALES
from martloom.sources import external, files, loading, sinks

NOW = dt.datetime(2024, 1, 20, 6)
HEADER = "a,b,c\n"


def put(folder, name, text):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    opener = gzip.open if name.endswith(".gz") else open
    with opener(path, "wt") as f:
        f.write(text)
    return path


def test_csv_quirks(spark, folder):
    put(folder, "x.csv", HEADER + '1,"x, ""y""", padded \n2,NULL\n3,N/A,z,extra\n4,\\N,\n')
    rows = files.read_delimited(spark, folder, "a string, b string, c string", load_time=NOW).orderBy("a").collect()
    assert [(r["a"], r["b"], r["c"]) for r in rows] == [
        ("1", 'x, "y"', "padded"), ("2", None, None), ("3", None, "z"), ("4", None, None)]
    assert [r["_file_row_number"] for r in rows] == [1, 2, 3, 4]
    assert all(r["_source_file"].endswith("x.csv") and r["_load_timestamp"] == NOW for r in rows)


@pytest.mark.parametrize("name, text, fmt", [
    ("p.csv", "a|b|c\n1|x|y\n", files.CSV_PIPE), ("t.csv", "a\tb\tc\n1\tx\ty\n", files.TSV),
    ("n.csv", "1,x,y\n", files.CSV_NO_HEADER), ("z.csv.gz", HEADER + "1,x,y\n", files.CSV_STANDARD)])
def test_delimited_variants(spark, folder, name, text, fmt):
    put(folder, name, text)
    rows = files.read_delimited(spark, folder, "a string, b string, c string", fmt).select("a", "b", "c").collect()
    assert [tuple(r) for r in rows] == [("1", "x", "y")]


def test_row_numbers_over_many_splits(spark, folder):
    n = 20_000
    put(folder, "big.csv", HEADER + "".join(f"{i},x{i},y\n" for i in range(1, n + 1)))
    put(folder, "small.csv", HEADER + "".join(f"{i},x,y\n" for i in range(1, 51)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        rows = files.read_delimited(spark, folder, "a string, b string, c string")
        assert spark.read.csv(folder).rdd.getNumPartitions() > 5
        assert rows.filter(F.col("a").cast("bigint") != F.col("_file_row_number")).count() == 0
        assert rows.count() == n + 50
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_json_readers(spark, folder):
    lines = put(folder, "l/a.json", '{"a": 1, "b": null}\n{"a": \n{"a": 2, "a": 3}\n')
    docs = files.read_json_lines(spark, lines).orderBy("_file_row_number")
    assert [r["bad"] for r in docs.select(F.col("raw_json").isNull().alias("bad")).collect()] == [False, True, True]
    array = put(folder, "m/a.json", '[{"a": 1},\n {"a": 2}]')
    assert files.read_json_array(spark, array, "a int").count() == 2
    for bad in ('{"a": 1, "a": 2}', '{"a": ', '{"a": 1}}', '{"a": "�"}'):
        with pytest.raises(Exception):
            files.read_json_strict(spark, put(folder, f"s{abs(hash(bad))}/a.json", bad + "\n")).collect()
    assert files.read_json_strict(spark, put(folder, "ok/a.json", '{"a": 1}\n')).count() == 1
    named = put(folder, "n/a.json", '{"EVENT_ID": "7", "Value": "x", "other": 1}\n')
    assert files.match_by_name(spark, named, "event_id int, value string").first() == (7, "x")


def test_avro_if_present(spark, folder):
    try:
        spark.range(3).write.format("avro").save(f"{folder}/a")
    except Exception:
        pytest.skip("the Avro module is not on the class path")
    assert files.read_avro(spark, f"{folder}/a").count() == 3


def test_parquet_binary_and_orc_trim(spark, folder):
    spark.sql("SELECT CAST('ab' AS BINARY) AS x, ' y ' AS y").write.parquet(f"{folder}/p")
    assert files.read_parquet(spark, f"{folder}/p", binary_as_text=True).first() == ("ab", " y ")
    spark.sql("SELECT ' y ' AS y, 1 AS n").write.orc(f"{folder}/o")
    assert files.read_orc(spark, f"{folder}/o").first() == ("y", 1)


def test_folder_columns_prune_files(spark, folder):
    for month in (1, 2):
        put(folder, f"year=2024/month={month:02d}/s.csv", ",".join(c.split()[0] for c in RAW_SALES.split(", "))
            + f"\nO{month},1,C,P,S,2024-0{month}-15 09:00:00,x,2.5,0,2.5,CASH,DONE\n")
    table = external.sales(spark, folder)
    row = table.filter("partition_month = 2").first()
    assert row["order_id"] == "O2" and row["quantity"] is None and row["partition_year"] == 2024
    plan = table.filter("partition_month = 2")._jdf.queryExecution().executedPlan().toString()
    assert "month" in plan.split("PartitionFilters:")[1].split("]")[0]


def test_list_files_since(spark, folder):
    old, new = put(folder, "old.csv", "x"), put(folder, "new.csv", "y")
    os.utime(old, (1_000_000_000, 1_000_000_000))
    found = files.list_files(spark, folder, since=dt.datetime(2010, 1, 1)).collect()
    assert [os.path.basename(r["path"]) for r in found] == ["new.csv"] and new


COLUMNS = ",".join(c.split()[0] for c in RAW_SALES.split(", "))


def sale(i, quantity="1", date="2024-01-15 09:00:00"):
    return f"O{i},1,C1,P1,S1,{date},{quantity},10.00,0.00,10.00,cash,completed\n"


def good(i, cost="6.50", launched="2023-05-01"):
    return f'{{"product_id": "P{i}", "product_name": "N", "unit_cost": "{cost}", "launch_date": "{launched}"}}\n'


@pytest.fixture
def marked(spark, folder):
    put(folder, "good.json", "".join(good(i, launched="soon") for i in range(10)))
    put(folder, "one.json", good(20, "many") + "".join(good(i) for i in range(21, 30)))
    put(folder, "five.json", "".join(good(i, "cheap") for i in range(40, 45)) + "".join(good(i) for i in range(45, 50)))
    return loading.clean_products(files.read_json_lines(spark, folder, load_time=NOW))


def test_unreadable_soft_fields_load_as_null(spark, folder, marked):
    put(folder, "sales/a.csv", COLUMNS + "\n" + sale(1, "many") + sale(2, date="soon") + sale(3))
    sales = loading.clean_sales(files.read_delimited(spark, f"{folder}/sales", RAW_SALES, load_time=NOW))
    kept, rejected = loading.apply_on_error(sales, "SKIP_FILE")
    assert (kept.count(), rejected.count()) == (3, 0)
    assert {(r["file_row_number"], r["field"]) for r in loading.missed_fields(sales).collect()} == {
        (1, "quantity"), (2, "transaction_date")}
    assert {r["field"] for r in loading.missed_fields(marked).collect()} == {"launch_date"}


@pytest.mark.parametrize("policy, rows", [
    ("CONTINUE", 24), ("SKIP_FILE", 10), ("SKIP_FILE_2", 19), ("SKIP_FILE_10%", 10), ("SKIP_FILE_40%", 19),
    ("SKIP_FILE_90%", 24)])
def test_error_policies(marked, policy, rows):
    good, rejected = loading.apply_on_error(marked, policy)
    assert good.count() == rows and rejected.count() == 6


def test_abort_and_validation(marked):
    with pytest.raises(ValueError, match="load aborted"):
        loading.apply_on_error(marked, "ABORT_STATEMENT")
    assert loading.validate(marked, "RETURN_5_ROWS").count() == 5
    assert loading.validate(marked, "RETURN_ERRORS").count() == 6


def test_load_history(marked):
    rows = {os.path.basename(r["file_name"]): r for r in loading.load_history(marked, NOW, "SKIP_FILE").collect()}
    assert (rows["good.json"]["status"], rows["good.json"]["row_count"]) == ("LOADED", 10)
    assert (rows["five.json"]["status"], rows["five.json"]["row_count"]) == ("LOAD_SKIPPED", 0)
    assert rows["one.json"]["first_error_line_number"] == 1
    assert rows["one.json"]["first_error_message"] == "cannot read unit_cost"


def test_incremental_load_and_registry(spark, folder):
    landing, target, registry = f"{folder}/in", f"{folder}/out", f"{folder}/reg"

    def read(session, paths):
        return files.read_delimited(session, paths, RAW_SALES, load_time=NOW)

    def load(batch, **options):
        return loading.incremental_load(spark, landing, target, registry, read, loading.clean_sales, batch, NOW,
                                        **options)

    put(folder, "in/a.csv", COLUMNS + "\n" + sale(1) + sale(2, "many"))
    assert load("b1") == 2 and load("b2") == 0
    put(folder, "in/b.csv", COLUMNS + "\n" + sale(3) + sale(4))
    with pytest.raises(ValueError, match="loaded already"):
        load("b1")
    assert load("b3") == 2
    known = {r["file_name"]: r for r in loading.read_registry(spark, registry).collect()}
    assert known["a.csv"]["rows_loaded"] == 2 and known["a.csv"]["error_message"] is None
    assert known["b.csv"]["batch_id"] == "b3" and known["b.csv"]["process_status"] == "LOADED"
    assert load("b4", force=True) == 4
    listed = files.list_files(spark, landing)
    empty = loading.read_registry(spark, f"{folder}/none")
    first = listed.orderBy("modification_time", "path").first()
    assert loading.pending_files(listed, empty, size_limit=first["length"]).count() == 1


def test_skipped_files_load_after_repair(spark, folder):
    landing, target, registry = f"{folder}/in", f"{folder}/out", f"{folder}/reg"

    def load(batch):
        return loading.incremental_load(spark, landing, target, registry, lambda s, p: files.read_json_lines(s, p, load_time=NOW),
                                        loading.clean_products, batch, NOW, "SKIP_FILE")

    put(folder, "in/a.json", good(1) + good(2, "cheap"))
    put(folder, "in/b.json", good(3))
    assert load("b1") == 1
    known = {r["file_name"]: r["process_status"] for r in loading.read_registry(spark, registry).collect()}
    assert known == {"a.json": "LOAD_SKIPPED", "b.json": "LOADED"}
    put(folder, "in/a.json", good(1) + good(2))
    assert load("b2") == 2


def test_audit_rows(spark, folder):
    def broken():
        raise RuntimeError("no space")

    clock = iter([NOW, NOW + dt.timedelta(minutes=1), NOW, NOW]).__next__
    assert loading.run_with_audit(spark, folder, "SALES", lambda: (5, 1), "b1", clock) == "COMPLETED"
    assert loading.run_with_audit(spark, folder, "SALES", broken, "b2", clock) == "FAILED"
    rows = {r["batch_id"]: r for r in loading.read_audit(spark, folder).collect()}
    assert (rows["b1"]["rows_loaded"], rows["b1"]["rows_rejected"], rows["b1"]["status"]) == (5, 1, "COMPLETED")
    assert rows["b1"]["load_end_time"] - rows["b1"]["load_start_time"] == dt.timedelta(minutes=1)
    assert (rows["b2"]["status"], rows["b2"]["error_message"]) == ("FAILED", "no space")


def test_versions(spark, folder):
    t = [dt.datetime(2024, 1, d, 12) for d in (1, 2, 3)]
    for n, at in enumerate(t):
        sinks.write_version(spark.range(n + 1), folder, at)
    assert sinks.read_as_of(spark, folder).count() == 3
    assert sinks.read_as_of(spark, folder, t[1]).count() == 2
    assert sinks.read_as_of(spark, folder, seconds_ago=86400, now=t[1]).count() == 1
    with pytest.raises(ValueError):
        sinks.read_as_of(spark, folder, dt.datetime(2023, 1, 1))
    copy = f"{folder}-copy"
    assert sinks.refresh_copies(spark, {folder: copy}, t[2]) and sinks.read_as_of(spark, copy).count() == 3
    # A version that was written but not committed is not read.
    spark.range(99).write.parquet(f"{folder}/snapshot=20250101T000000")
    assert sinks.read_as_of(spark, folder).count() == 3


def test_clustering_report(spark, folder):
    df = spark.range(10_000).withColumn("k", (F.col("id") * 7919) % 10_000)
    sinks.write_clustered(df, f"{folder}/sorted", ["k"], 4)
    df.repartition(4, "id").write.parquet(f"{folder}/mixed")
    assert tuple(sinks.clustering_report(spark, f"{folder}/sorted", "k").first()) == (4, 0.0, 1.0)
    mixed = sinks.clustering_report(spark, f"{folder}/mixed", "k").first()
    assert (mixed["files"], mixed["avg_overlaps"]) == (4, 3.0) and mixed["avg_depth"] == 2.5


def test_seed_stores_and_objects(spark):
    assert loading.seed_stores(spark).count() == 5
    found = quality.tables_exist(["DIM_DATE", "FACT_SALES"], {"CURATED": (["DIM_DATE", "FACT_SALES", "DIM_STORE"], 3),
                                                              "FACTS": (["FACT_SALES"], 1)})
    assert [(t, s) for t, s, _ in found] == [("CURATED", "FAIL"), ("FACTS", "PASS")]
