"""The clickstream as one job: raw lines in; staged events, rejected lines and facts out, under one commit a batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from martloom.functions import casts
from martloom.functions.variants import path as at
from martloom.functions.variants import safe_json
from martloom.operators import facts, quality
from martloom.sources import files, loading, sinks
from martloom.streaming.ingest import per_batch

GOOD, BAD = "good", "bad"


def unique_lines(lines: DataFrame, delay: str) -> DataFrame:
    """Lines as documents, each event id once within ``delay``.

    A line without an id or a time keeps its place in the batch: it gets an id of its own and the time of its file, so
    that it neither hides nor is hidden, and is rejected later.
    """
    rows = files.with_source(lines.withColumnRenamed("value", "raw_text")).withColumn("raw_json", safe_json(F.col("raw_text")))
    doc = F.col("raw_json")
    id_, time = at(doc, "event_id"), casts.try_timestamp(at(doc, "event_timestamp")).cast("timestamp")
    rows = rows.withColumn("_id", F.coalesce(id_, F.expr("uuid()"))).withColumn(
        "_time", F.coalesce(time, F.col("_file_last_modified").cast("timestamp")))
    return rows.withWatermark("_time", delay).dropDuplicatesWithinWatermark(["_id"])


def staged(rows: DataFrame) -> DataFrame:
    """Typed events with their verdict; ``sink`` says whether they are good, ``rejection_reason`` why not."""
    place = rows.withColumn("_file_row_number", F.lit(None).cast("bigint")).withColumn(
        "_load_timestamp", F.col("_file_last_modified"))
    typed = loading.clean_clickstream(place)
    marked = quality.mark_clicks(typed)
    unread = F.size(loading.ERRORS) > 0
    good = ~unread & F.col("dq_is_valid")
    reason = F.when(F.array_contains(loading.ERRORS, "_ok"), "malformed JSON").when(
        unread, F.concat(F.lit("cannot read "), F.array_join(loading.ERRORS, ", "))).when(
        ~F.col("dq_is_valid"), F.col("dq_error_details"))
    return marked.withColumn("sink", F.when(good, GOOD).otherwise(BAD)).withColumn("rejection_reason", reason).drop(
        loading.ERRORS, loading.MISSED)


def clickstream(lines: DataFrame, out: str, calendar: Callable[[], DataFrame], customer: Callable[[], DataFrame],
                checkpoint: str, delay: str = "1 day", trigger: dict | None = None) -> StreamingQuery:
    """Runs the job over a stream of text lines (column ``value``).

    A batch is parsed once and written once, dealt to ``rows/batch=n/sink=good`` and ``sink=bad``; facts are made from the
    good rows written, with the dimensions as they are then. The batch counts when its commit is there, which comes last;
    a batch that died is run again by Spark under the same number and writes over what it left.
    """
    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = f"{out}/rows/batch={number}"
        dealt = staged(batch)
        dealt.write.mode("overwrite").partitionBy("sink").parquet(rows)
        good = spark.read.schema(dealt.schema).parquet(rows).filter(F.col("sink") == GOOD).drop("sink")
        facts.load_clickstream(good, calendar(), customer()).write.mode("overwrite").parquet(f"{out}/facts/batch={number}")
        done = spark.createDataFrame([(number,)], "batch bigint")
        done.coalesce(1).write.mode("overwrite").json(f"{out}/{sinks.COMMITS}/batch={number}")

    return per_batch(unique_lines(lines, delay), checkpoint, write, trigger)


def _committed(spark: SparkSession, out: str, what: str) -> DataFrame:
    done = spark.read.schema("batch bigint").json(f"{out}/{sinks.COMMITS}/batch=*")
    return spark.read.parquet(f"{out}/{what}").join(F.broadcast(done), "batch", "left_semi")


def facts_of(spark: SparkSession, out: str) -> DataFrame:
    """Facts of all committed batches."""
    return _committed(spark, out, "facts")


def rows_of(spark: SparkSession, out: str, sink: str) -> DataFrame:
    """Good or bad rows of all committed batches."""
    return _committed(spark, out, "rows").filter(F.col("sink") == sink)
