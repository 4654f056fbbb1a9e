"""Loads whose registry is the checkpoint of a file stream: each file once, without a list of files on the driver.

A row keeps the place it was read from as (block of the file, row id in its task). Rows of a file sort by it as they stand in
the file, so nothing is numbered while rows load; only rejected rows get a line number, from one count per block of
their files.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from martloom.functions import casts
from martloom.functions.variants import safe_json
from martloom.session import materialise
from martloom.sources import files, loading
from martloom.streaming.ingest import ONCE, per_batch


def _streamed(spark: SparkSession, glob: str | None, most_bytes: int | None, **options: str):
    reader = spark.readStream.options(**options)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    # Files are taken oldest first until a batch holds so many bytes.
    return reader.option("maxBytesPerTrigger", str(most_bytes)) if most_bytes else reader


def _placed(rows: DataFrame) -> DataFrame:
    return files.with_source(rows.withColumn("_block", F.col("_metadata.file_block_start")))


def delimited(spark: SparkSession, path: str, schema: str, fmt: files.Delimited = files.CSV_STANDARD,
              glob: str | None = None, most_bytes: int | None = None) -> DataFrame:
    """New delimited files as a stream of text columns, NULL tokens mapped."""
    names = [c.split()[0] for c in schema.split(", ")]
    reader = _streamed(spark, glob, most_bytes, **files.delimited_options(fmt))
    rows = _placed(reader.schema(", ".join(f"{n} string" for n in names)).csv(path))
    return rows.select(*[casts.null_if_token(F.col(n), fmt.null_tokens).alias(n) for n in names],
                       *[c for c in rows.columns if c not in names])


def json_lines(spark: SparkSession, path: str, glob: str | None = None, most_bytes: int | None = None) -> DataFrame:
    """New files of one document a line as a stream: ``raw_text``, and ``raw_json`` or NULL."""
    rows = _placed(_streamed(spark, glob, most_bytes).text(path)).withColumnRenamed("value", "raw_text")
    return rows.withColumn("raw_json", safe_json(F.col("raw_text")))


def line_numbers(rows: DataFrame, every: DataFrame) -> DataFrame:
    """Line numbers (from 1, a header not counted) in place of the places of ``rows``; ``every`` holds all rows of their files."""
    of_these = rows.select("source_file").distinct()
    splits = every.join(of_these, "source_file", "left_semi").groupBy("source_file", F.col("file_row_number.block").alias("_block")).agg(
        F.min("file_row_number.at").alias("_first"), F.count("*").alias("_n"))
    earlier = Window.partitionBy("source_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    met = rows.withColumn("_block", F.col("file_row_number.block")).join(splits, ["source_file", "_block"])
    number = F.col("file_row_number.at") - F.col("_first") + F.col("_before") + 1
    return met.withColumn("file_row_number", number).select(*rows.columns)


def load(stream: DataFrame, target: str, checkpoint: str, clean: Callable[[DataFrame], DataFrame], now: Callable[[], dt.datetime],
         policy: str = "CONTINUE", trigger: dict | None = None) -> StreamingQuery:
    """Loads a stream of ``delimited`` or ``json_lines``: good rows to ``{target}/batch=n``, rejected ones with their line
    number to ``{target}_rejected/batch=n``, one row a file to ``{target}_files/batch=n``.

    Each file is parsed once. The stream moves on when all three are written; a batch that died is loaded again under its
    number. The error policies see the files of one batch.
    """
    def write(batch: DataFrame, number: int) -> None:
        stamp = F.lit(str(now())).cast("timestamp_ntz")
        at = F.struct(F.col("_block").alias("block"), F.monotonically_increasing_id().alias("at"))
        marked = materialise(clean(batch.withColumn("_file_row_number", at).withColumn("_load_timestamp", stamp)), "marked")
        good, rejected = loading.apply_on_error(marked, policy)
        good.write.mode("overwrite").parquet(f"{target}/batch={number}")
        line_numbers(rejected, marked).write.mode("overwrite").parquet(f"{target}_rejected/batch={number}")
        bad = F.size(loading.ERRORS) > 0
        per_file = marked.groupBy("source_file").agg(F.count("*").alias("row_parsed"), F.count_if(bad).alias("error_count"))
        loaded = good.groupBy("source_file").agg(F.count("*").alias("rows_loaded"))
        per_file.join(loaded, "source_file", "left").withColumn(
            "rows_loaded", F.coalesce("rows_loaded", F.lit(0))).withColumn("process_timestamp", stamp).write.mode(
            "overwrite").parquet(f"{target}_files/batch={number}")

    return per_batch(stream, checkpoint, write, trigger or ONCE)
