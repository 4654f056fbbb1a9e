"""Readers for the landing formats, with per-row file metadata."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions import casts
from martloom.functions.variants import safe_json


@dataclass(frozen=True)
class Delimited:
    """Options of a delimited text format."""

    separator: str = ","
    header: bool = True
    null_tokens: Sequence[str] = field(default=casts.NULL_TOKENS_STANDARD)
    trim: bool = False


# The named formats.
CSV_STANDARD = Delimited(trim=True)
CSV_NO_HEADER = Delimited(header=False, null_tokens=casts.NULL_TOKENS_NO_HEADER)
CSV_PIPE = Delimited(separator="|", null_tokens=casts.NULL_TOKENS_PIPE_TSV)
TSV = Delimited(separator="\t", null_tokens=casts.NULL_TOKENS_PIPE_TSV)

SOURCE_COLUMNS = ("_source_file", "_file_row_number", "_file_last_modified", "_load_timestamp")


def _source_columns() -> list[Column]:
    name = F.regexp_replace(F.col("_metadata.file_path"), "^([a-z0-9]+):/+", "$1:/")
    return [name.alias("_source_file"),
            F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("_file_last_modified")]


def with_source(df: DataFrame) -> DataFrame:
    """File name and time of each row; must be the first step after a file scan."""
    return df.select("*", *_source_columns())


def with_row_numbers(df: DataFrame, load_time: dt.datetime | None = None) -> DataFrame:
    """Adds file, row number in the file (from 1), file time and load time.

    A row's place in its split comes from the scan order; rows of earlier splits
    of the file are added from one count per split. No window runs over rows, so
    a single huge file stays spread over its splits, and as the counts go to the
    rows, one for each split, the rows are not shuffled.
    """
    tagged = df.select("*", *_source_columns(), F.col("_metadata.file_block_start").alias("_block"),
                       F.monotonically_increasing_id().alias("_at"))
    splits = tagged.groupBy("_source_file", "_block").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    earlier = Window.partitionBy("_source_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    number = (F.col("_at") - F.col("_first") + F.col("_before") + 1).cast("bigint")
    stamp = F.lit(str(load_time) if load_time else None).cast("timestamp_ntz")
    return (
        tagged.join(F.broadcast(offsets), ["_source_file", "_block"])
        .withColumn("_file_row_number", number)
        .withColumn("_load_timestamp", stamp)
        .select(*[c for c in df.columns], *SOURCE_COLUMNS)
    )


def delimited_options(fmt: Delimited) -> dict[str, str]:
    """Reader options of a format. Columns are read as text, short and long rows are tolerated."""
    trim = str(fmt.trim).lower()
    return {"header": str(fmt.header).lower(), "sep": fmt.separator, "quote": '"', "escape": '"', "mode": "PERMISSIVE",
            "enforceSchema": "true", "ignoreLeadingWhiteSpace": trim, "ignoreTrailingWhiteSpace": trim}


def _scan_delimited(spark: SparkSession, path: str | list[str], schema: str | T.StructType, fmt: Delimited) -> DataFrame:
    names = (schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)).names
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return spark.read.schema(text).options(**delimited_options(fmt)).csv(path)


def read_delimited(spark: SparkSession, path: str | list[str], schema: str | T.StructType,
                   fmt: Delimited = CSV_STANDARD, load_time: dt.datetime | None = None) -> DataFrame:
    """All columns as text. Short rows are filled with NULL, extra fields dropped, NULL tokens mapped."""
    raw = _scan_delimited(spark, path, schema, fmt)
    numbered = with_row_numbers(raw, load_time)
    return numbered.select(
        *[casts.null_if_token(F.col(c), fmt.null_tokens).alias(c) for c in raw.columns], *SOURCE_COLUMNS)


def read_json_lines(spark: SparkSession, path: str | list[str], load_time: dt.datetime | None = None,
                    numbered: bool = True) -> DataFrame:
    """One document per line as VARIANT ``raw_json``; a bad line gives NULL, its text stays in ``raw_text``."""
    lines = spark.read.text(path).withColumnRenamed("value", "raw_text")
    tagged = with_row_numbers(lines, load_time) if numbered else with_source(lines)
    return tagged.withColumn("raw_json", safe_json(F.col("raw_text")))


def read_json_array(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """Files that hold one outer array: one row per element. Such a file cannot be split."""
    return with_source(spark.read.schema(schema).option("multiLine", "true").json(path))


def read_json_strict(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Fails on a bad document, a repeated key or a broken character."""
    lines = with_source(spark.read.text(path).withColumnRenamed("value", "raw_text"))
    sound = F.when(F.col("raw_text").contains("�"), F.raise_error(F.lit("broken character in JSON"))).otherwise(
        F.col("raw_text"))
    checked = lines.withColumn("raw_json", F.parse_json(sound))
    alone = F.when(safe_json(F.col("raw_text")).isNull(), F.raise_error(F.lit("text after the JSON value")))
    return checked.withColumn("raw_json", F.when(alone.isNull(), F.col("raw_json"))).drop("raw_text")


def read_parquet(spark: SparkSession, path: str | list[str], schema: str | None = None,
                 binary_as_text: bool = False) -> DataFrame:
    df = (spark.read.schema(schema) if schema else spark.read).parquet(path)
    if not binary_as_text:
        return df
    return df.select(*[
        (F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, T.BinaryType) else F.col(f.name))
        for f in df.schema.fields])


def read_avro(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Needs the Avro module on the class path."""
    return spark.read.format("avro").load(path)


def read_orc(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """ORC with text columns trimmed."""
    df = spark.read.orc(path)
    return df.select(*[
        (F.trim(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name))
        for f in df.schema.fields])


def read_xml(spark: SparkSession, path: str | list[str], row_tag: str, schema: str | None = None) -> DataFrame:
    """One row per ``row_tag`` element; the outer element is stripped."""
    reader = spark.read.format("xml").option("rowTag", row_tag)
    return (reader.schema(schema) if schema else reader).load(path)


def match_by_name(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """JSON loaded by column name, upper or lower case alike; of names that differ in case only, the last counts."""
    target = T.StructType.fromDDL(schema)
    lines = spark.read.text(path)
    fields = F.from_json("value", "map<string,string>")
    def last(name: str) -> Column:
        same = F.filter(F.map_entries("m"), lambda e: F.lower(e["key"]) == name.lower())
        return F.get(F.reverse(F.transform(same, lambda e: e["value"])), F.lit(0))

    return lines.select(fields.alias("m")).select(*[
        last(f.name).try_cast(f.dataType).alias(f.name) for f in target.fields])


def list_files(spark: SparkSession, path: str, since: dt.datetime | None = None, glob: str | None = None) -> DataFrame:
    """Files under a folder, optionally only those changed after ``since``. Contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(path).select(
        F.regexp_replace("path", "^([a-z0-9]+):/+", "$1:/").alias("path"), "length", F.col("modificationTime").cast("timestamp_ntz").alias("modification_time"))
    if since is not None:
        files = files.filter(F.col("modification_time") > F.lit(str(since)).cast("timestamp_ntz"))
    return files


def preview(spark: SparkSession, path: str, n: int = 10) -> DataFrame:
    """The first rows of a file as text fields with their place in it."""
    lines = with_row_numbers(spark.read.text(path))
    return lines.filter(F.col("_file_row_number") <= n).select(
        "_source_file", "_file_row_number", F.split("value", ",").alias("fields")).orderBy(
        "_source_file", "_file_row_number").limit(n)
