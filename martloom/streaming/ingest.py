"""Continuous file ingest, de-duplication and change feeds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from martloom.functions.variants import safe_json
from martloom.sources.files import with_source

ONCE = {"availableNow": True}


def source(spark: SparkSession, path: str, schema: str, fmt: str = "parquet", glob: str | None = None,
           files_per_batch: int | None = None) -> DataFrame:
    """Files of a folder as a stream, each file once."""
    reader = spark.readStream.schema(schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def start(df: DataFrame, out: str, checkpoint: str, trigger: dict | None = None, mode: str = "append") -> StreamingQuery:
    return (
        df.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint)
        .option("path", out).trigger(**(trigger or ONCE)).start()
    )


def ingest(spark: SparkSession, path: str, schema: str, out: str, checkpoint: str, fmt: str = "parquet",
           trigger: dict | None = None, glob: str | None = None) -> StreamingQuery:
    """Raw rows plus source file and time; a file is loaded once, also after a restart."""
    rows = with_source(source(spark, path, schema, fmt, glob))
    return start(rows.withColumn("_load_timestamp", F.current_timestamp()), out, checkpoint, trigger)


def deduplicate(events: DataFrame, key: str, ts: str, delay: str) -> DataFrame:
    """Drops a repeated key that comes within ``delay`` of the first; state is kept no longer than that."""
    return events.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def per_batch(df: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None],
              trigger: dict | None = None) -> StreamingQuery:
    """Hands each batch to ``write(rows, batch_id)``; the position moves only when it returns."""
    return (
        df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or ONCE)).start()
    )


def consume(df: DataFrame, out: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Exactly-once copy of a change feed: a batch overwrites its own folder, so a replay leaves one copy."""
    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return per_batch(df, checkpoint, write, trigger)


def split_bad_records(lines: DataFrame, text: str, good: str, bad: str, checkpoint: str,
                      trigger: dict | None = None) -> StreamingQuery:
    """Well-formed documents to ``good``, the text of the others to ``bad``."""
    def write(rows: DataFrame, batch_id: int) -> None:
        parsed = rows.withColumn("raw_json", safe_json(F.col(text)))
        fine = F.col("raw_json").isNotNull()
        parsed.filter(fine).write.mode("overwrite").parquet(f"{good}/batch_id={batch_id}")
        rejected = parsed.filter(~fine).drop("raw_json").withColumn("rejection_reason", F.lit("malformed JSON"))
        rejected.write.mode("overwrite").parquet(f"{bad}/batch_id={batch_id}")

    return per_batch(lines, checkpoint, write, trigger)
