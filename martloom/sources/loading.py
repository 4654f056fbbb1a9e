"""Loads from landing to staging: typing, error policies, registry, audit."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martloom.functions import casts, hashing
from martloom.functions.variants import path as at
from martloom.schemas import FILE_REGISTRY, LOAD_AUDIT, STORES
from martloom.session import materialise, release
from martloom.sources import files, sinks

# The reference stores.
STORE_ROWS = (
    ("STORE-001", "Downtown Flagship", "RETAIL", "New York", "NY", "Northeast", "USA", True, "2020-01-15"),
    ("STORE-002", "West Coast Hub", "RETAIL", "Los Angeles", "CA", "West", "USA", True, "2020-03-20"),
    ("STORE-003", "Central Distribution", "WAREHOUSE", "Chicago", "IL", "Midwest", "USA", True, "2019-06-01"),
    ("STORE-004", "Tech Valley Store", "RETAIL", "San Francisco", "CA", "West", "USA", True, "2021-02-10"),
    ("STORE-005", "Outlet Mall Location", "OUTLET", "Dallas", "TX", "South", "USA", True, "2021-08-15"),
)

#: Names of fields that could not be read: hard ones fail the row, soft ones are NULL and the row loads.
ERRORS, MISSED = "_errors", "_missed"


def seed_stores(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(list(STORE_ROWS), STORES)
    return rows.withColumn("open_date", F.col("open_date").cast("date")).withColumn("dq_is_valid", F.lit(True))


def _typed(raw: DataFrame, columns: Mapping[str, Column], hard: Mapping[str, Column],
           soft: Mapping[str, Column]) -> DataFrame:
    """Typed columns plus ``_errors`` and ``_missed``: the hard and soft names whose text was set but not readable."""
    def wrong(checked: Mapping[str, Column]) -> Column:
        names = [F.when(text.isNotNull() & columns[name].isNull(), F.lit(name)) for name, text in checked.items()]
        return F.array_compact(F.array(*names)).cast("array<string>")

    return raw.select(
        *[c.alias(name) for name, c in columns.items()],
        F.col("_source_file").alias("source_file"), F.col("_file_row_number").alias("file_row_number"),
        F.col("_load_timestamp").alias("load_timestamp"),
        wrong(hard).alias(ERRORS), wrong(soft).alias(MISSED),
    )


def clean_sales(raw: DataFrame) -> DataFrame:
    c = F.col
    columns = {
        "order_id": c("order_id"),
        "order_line_id": casts.try_number(c("order_line_id"), "int"),
        "customer_id": c("customer_id"), "product_id": c("product_id"), "store_id": c("store_id"),
        "transaction_date": casts.try_timestamp(c("transaction_date")),
        "quantity": casts.try_number(c("quantity"), "int"),
        "unit_price": casts.try_decimal(c("unit_price"), 10, 2),
        "discount_percent": casts.try_decimal(c("discount_percent"), 5, 2),
        "total_amount": casts.try_decimal(c("total_amount"), 12, 2),
        "payment_method": F.upper(F.trim("payment_method")),
        "order_status": F.upper(F.trim("order_status")),
    }
    soft = ("order_line_id", "transaction_date", "quantity", "unit_price", "discount_percent", "total_amount")
    return _typed(raw, columns, {}, {n: c(n) for n in soft})


def clean_customers(raw: DataFrame) -> DataFrame:
    def tidy(name: str, how: Callable) -> Column:
        return how(F.trim(name))

    c = F.col
    columns = {
        "customer_id": c("customer_id"),
        "first_name": tidy("first_name", F.initcap), "last_name": tidy("last_name", F.initcap),
        "email": tidy("email", F.lower), "phone": c("phone"),
        "date_of_birth": casts.try_date(c("date_of_birth")), "gender": tidy("gender", F.upper),
        "registration_date": casts.try_date(c("registration_date")),
        "customer_segment": tidy("customer_segment", F.upper),
        "address_line1": c("address_line1"), "city": tidy("city", F.initcap), "state": tidy("state", F.upper),
        "postal_code": c("postal_code"), "country": tidy("country", F.upper),
        "loyalty_points": casts.try_number(c("loyalty_points"), "int"),
        "preferred_contact": tidy("preferred_contact", F.upper),
        "is_active": casts.try_boolean(c("is_active")),
        "record_hash": hashing.record_hash(hashing.CUSTOMER_HASH_FIELDS),
    }
    soft = ("date_of_birth", "registration_date", "loyalty_points", "is_active")
    return _typed(raw, columns, {}, {n: c(n) for n in soft})


def clean_inventory(raw: DataFrame) -> DataFrame:
    c = F.col
    counts = ("quantity_on_hand", "quantity_reserved", "reorder_point", "reorder_qty")
    columns = {
        "inventory_id": c("inventory_id"), "product_id": c("product_id"), "store_id": c("store_id"),
        **{n: casts.try_number(c(n), "int") for n in counts},
        "last_restock_date": casts.try_date(c("last_restock_date")),
        "snapshot_timestamp": casts.try_timestamp(c("snapshot_timestamp")),
    }
    return _typed(raw, columns, {}, {n: c(n) for n in (*counts, "last_restock_date", "snapshot_timestamp")})


# Document fields and their staging types.
PRODUCT_TYPES = {
    "product_id": "string", "product_name": "string", "category": "string", "subcategory": "string",
    "brand": "string", "unit_cost": "decimal(10,2)", "unit_price": "decimal(10,2)", "weight_kg": "decimal(8,3)",
    "is_active": "boolean",
}
CLICK_TYPES = {
    "event_id": "string", "session_id": "string", "customer_id": "string", "page_url": "string",
    "referrer_url": "string", "browser": "string", "os": "string", "ip_address": "string",
    "duration_seconds": "int", "scroll_depth_percent": "int", "product_id": "string", "quantity": "int",
    "order_id": "string", "order_value": "decimal(12,2)", "cart_value": "decimal(12,2)", "search_query": "string",
}


def _document(raw: DataFrame, columns: dict[str, Column], hard: Sequence[str], soft: Sequence[str]) -> DataFrame:
    """Documents: a text that is no document fails its row."""
    doc = F.col("raw_json")
    columns = {"_ok": F.when(doc.isNotNull(), True), **columns}
    texts = {n: at(doc, n) for n in hard} | {"_ok": F.col("raw_text")}
    return _typed(raw, columns, texts, {n: at(doc, n) for n in soft}).drop("_ok")


def clean_products(raw: DataFrame) -> DataFrame:
    doc = F.col("raw_json")
    columns = {name: at(doc, name, kind) for name, kind in PRODUCT_TYPES.items()}
    columns["launch_date"] = casts.try_date(at(doc, "launch_date"))
    columns["attributes"] = F.try_variant_get(doc, "$.attributes", "variant")
    return _document(raw, columns, ("unit_cost", "unit_price", "weight_kg", "is_active"), ("launch_date",))


def click_columns() -> dict[str, Column]:
    doc = F.col("raw_json")
    columns = {name: at(doc, name, kind) for name, kind in CLICK_TYPES.items()}
    columns["event_timestamp"] = casts.try_timestamp(at(doc, "event_timestamp"))
    columns["event_type"] = F.upper(at(doc, "event_type"))
    columns["device_type"] = F.lower(at(doc, "device_type"))
    return columns


def clean_clickstream(raw: DataFrame) -> DataFrame:
    return _document(raw, click_columns(), ("duration_seconds", "quantity", "order_value"), ("event_timestamp",))


# Error policies

def _is_bad() -> Column:
    return F.size(ERRORS) > 0


def _reason() -> Column:
    return F.concat(F.lit("cannot read "), F.array_join(ERRORS, ", "))


def bad_files(marked: DataFrame, policy: str) -> DataFrame:
    """Files a SKIP_FILE policy drops: on the first error, after n errors, or from n percent."""
    per_file = marked.groupBy("source_file").agg(
        F.count_if(_is_bad()).alias("bad"), F.count("*").alias("total"))
    limit = policy.removeprefix("SKIP_FILE").removeprefix("_")
    if not limit:
        rule = F.col("bad") > 0
    elif limit.endswith("%"):
        rule = F.col("bad") * 100 >= F.col("total") * float(limit[:-1])
    else:
        rule = F.col("bad") >= int(limit)
    return per_file.filter(rule & (F.col("bad") > 0)).select("source_file")


def apply_on_error(marked: DataFrame, policy: str = "CONTINUE") -> tuple[DataFrame, DataFrame]:
    """Rows to load and rows rejected (with a reason) under an error policy."""
    rejected = marked.filter(_is_bad()).withColumn("rejection_reason", _reason()).drop(ERRORS, MISSED)
    good = marked.filter(~_is_bad()).drop(ERRORS, MISSED)
    if policy == "CONTINUE":
        return good, rejected
    if policy == "ABORT_STATEMENT":
        first = rejected.select("source_file", "file_row_number", "rejection_reason").head(1)
        if first:
            raise ValueError(f"load aborted: {first[0].asDict()}")
        return good, rejected
    if not policy.startswith("SKIP_FILE"):
        raise ValueError(f"unknown policy {policy}")
    skipped = bad_files(marked, policy)
    return good.join(skipped, "source_file", "left_anti").select(*good.columns), rejected


def missed_fields(marked: DataFrame) -> DataFrame:
    """One row per field that was set, could not be read, and loads as NULL."""
    return marked.filter(~_is_bad()).select("source_file", "file_row_number", F.explode(MISSED).alias("field"))


def validate(marked: DataFrame, mode: str) -> DataFrame:
    """Dry run: the first n rows that would load, or the rows that would fail."""
    good, rejected = apply_on_error(marked)
    if mode in ("RETURN_ERRORS", "RETURN_ALL_ERRORS"):
        return rejected
    n = int(mode.removeprefix("RETURN_").removesuffix("_ROWS"))
    return good.orderBy("source_file", "file_row_number").limit(n)


def load_history(marked: DataFrame, at_time: dt.datetime, policy: str = "CONTINUE") -> DataFrame:
    """Per file: rows parsed, loaded and failed, the first error, status."""
    place = F.struct("file_row_number", _reason().alias("reason"))
    per_file = marked.groupBy("source_file").agg(
        F.count("*").alias("row_parsed"),
        F.count_if(_is_bad()).alias("error_count"),
        F.min(F.when(_is_bad(), place)).alias("_first"),
    )
    status = F.when(F.col("error_count") == 0, "LOADED")
    loaded = F.col("row_parsed") - F.col("error_count")
    if policy.startswith("SKIP_FILE"):
        skipped = bad_files(marked, policy).withColumn("_skipped", F.lit(True))
        per_file = per_file.join(skipped, "source_file", "left")
        status = status.when(F.col("_skipped"), "LOAD_SKIPPED")
        loaded = F.when(F.col("_skipped"), 0).otherwise(loaded)
    return per_file.select(
        F.col("source_file").alias("file_name"), loaded.alias("row_count"), "row_parsed", "error_count",
        F.col("_first.reason").alias("first_error_message"),
        F.col("_first.file_row_number").alias("first_error_line_number"),
        status.otherwise("PARTIALLY_LOADED").alias("status"),
        F.lit(str(at_time)).cast("timestamp_ntz").alias("last_load_time"))


# Incremental loads

def pending_files(found: DataFrame, registry: DataFrame, force: bool = False,
                  size_limit: int | None = None) -> DataFrame:
    """Files not yet LOADED, oldest first; ``size_limit`` stops before the sum of bytes passes it.

    Runs over the file listing, never over rows.
    """
    done = registry.filter(F.col("process_status") == "LOADED").select(F.col("file_path").alias("path"))
    todo = found if force else found.join(done, "path", "left_anti")
    if size_limit is None:
        return todo
    upto = Window.orderBy("modification_time", "path")
    before = F.sum("length").over(upto.rowsBetween(Window.unboundedPreceding, -1))
    return todo.withColumn("_b", F.coalesce(before, F.lit(0))).filter(F.col("_b") < size_limit).drop("_b")


def registry_rows(todo: DataFrame, history: DataFrame, batch_id: str, now: dt.datetime) -> DataFrame:
    """One row per file: LOADED, or LOAD_SKIPPED if the error policy dropped it; only LOADED files are not tried again."""
    skipped = F.col("status") == "LOAD_SKIPPED"
    counts = history.select(F.col("file_name").alias("path"), F.col("row_count").alias("rows_loaded"),
                            F.col("first_error_message").alias("error_message"),
                            F.when(skipped, F.col("status")).otherwise("LOADED").alias("status"))
    rows = todo.join(counts, "path", "left").select(
        F.col("path").alias("file_path"), F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.col("length").alias("file_size_bytes"), F.col("modification_time").alias("file_modified_date"),
        F.coalesce("status", F.lit("LOADED")).alias("process_status"), F.lit(str(now)).cast("timestamp_ntz").alias("process_timestamp"),
        F.lit(batch_id).alias("batch_id"), F.coalesce("rows_loaded", F.lit(0)).alias("rows_loaded"), "error_message")
    return rows


def read_registry(spark: SparkSession, base: str) -> DataFrame:
    if not sinks._exists(spark, base):
        return spark.createDataFrame([], FILE_REGISTRY)
    return spark.read.schema(FILE_REGISTRY).parquet(base)


def incremental_load(spark: SparkSession, source: str, target: str, registry: str, read: Callable, clean: Callable,
                     batch_id: str, now: dt.datetime, policy: str = "CONTINUE", force: bool = False,
                     size_limit: int | None = None, glob: str | None = None) -> int:
    """Loads the files not in the registry into ``target`` and registers them; gives the rows loaded.

    Rows go to a folder of the batch, overwritten on a retry, and the registry is
    written last: a batch that died half-way is loaded again, once. A batch id that
    is in the registry is not used again.
    """
    todo = pending_files(files.list_files(spark, source, glob=glob), read_registry(spark, registry), force, size_limit)
    paths = [r["path"] for r in todo.select("path").orderBy("path").collect()]
    if not paths:
        return 0
    if sinks._exists(spark, f"{registry}/batch={batch_id}"):
        raise ValueError(f"batch {batch_id} is loaded already; new files need a new batch id")
    # Parsed once; the rows, the rejects and the history are read from the typed copy.
    marked = materialise(clean(read(spark, paths)), "marked")
    good, rejected = apply_on_error(marked, policy)
    good.write.mode("overwrite").parquet(f"{target}/batch={batch_id}", compression=sinks.STORED)
    rejected.write.mode("overwrite").parquet(f"{target}_rejected/batch={batch_id}")
    registry_rows(todo, load_history(marked, now, policy), batch_id, now).write.mode("overwrite").parquet(
        f"{registry}/batch={batch_id}")
    release(marked)
    return spark.read.parquet(f"{target}/batch={batch_id}").count()


def run_with_audit(spark: SparkSession, audit: str, table: str, load: Callable[[], tuple[int, int]], batch_id: str,
                   clock: Callable[[], dt.datetime], source: str | None = None, pattern: str | None = None) -> str:
    """Runs a load that gives (rows loaded, rows rejected) and keeps one audit row for it."""
    started = clock()

    def write(end, loaded, rejected, status, message):
        row = (batch_id, table, source, pattern, started, end, loaded, rejected, status, message)
        spark.createDataFrame([row], LOAD_AUDIT).coalesce(1).write.mode("overwrite").parquet(
            f"{audit}/batch={batch_id}")

    write(None, None, None, "STARTED", None)
    try:
        loaded, rejected = load()
    except Exception as error:
        write(clock(), None, None, "FAILED", str(error))
        return "FAILED"
    write(clock(), loaded, rejected, "COMPLETED", None)
    return "COMPLETED"


def read_audit(spark: SparkSession, audit: str) -> DataFrame:
    return spark.read.schema(LOAD_AUDIT).parquet(audit)
