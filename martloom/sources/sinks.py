"""Writing: plain unloads, versioned tables, clustered layouts.

A versioned table is a folder of snapshots plus a small commit list. A writer
fills a new snapshot folder and then appends its commit, so a reader never sees
a half-written version and a job can read a table while writing the next one.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martloom.operators.keys import pieces

COMMITS = "_commits"
#: Codec of what is stored for good: tables of batches, their logs and staged rows.
STORED = "zstd"
COMMIT_SCHEMA = "version bigint, committed_at timestamp_ntz, path string, row_count bigint"


def unload(df: DataFrame, path: str, fmt: str = "parquet", overwrite: bool = True, header: bool = True,
           **options: str) -> None:
    """Writes a query result as files."""
    writer = df.write.format(fmt).mode("overwrite" if overwrite else "errorifexists")
    if fmt == "csv":
        writer = writer.option("header", str(header).lower())
    writer.options(**options).save(path)


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def commits(spark: SparkSession, base: str) -> DataFrame:
    """The committed versions; empty if the table has none."""
    if not _exists(spark, f"{base}/{COMMITS}"):
        return spark.createDataFrame([], COMMIT_SCHEMA)
    return spark.read.schema(COMMIT_SCHEMA).json(f"{base}/{COMMITS}")


def write_version(df: DataFrame, base: str, at: dt.datetime, cluster_by: Sequence[str] = ()) -> int:
    """Writes the next snapshot and commits it; the same ``at`` again replaces that snapshot."""
    spark = df.sparkSession
    stamp = at.strftime("%Y%m%dT%H%M%S")
    path = f"{base}/snapshot={stamp}"
    if cluster_by:
        write_clustered(df, path, cluster_by)
    else:
        df.write.mode("overwrite").parquet(path)
    rows = spark.read.parquet(path).count()
    version = int(stamp.replace("T", ""))
    row = spark.createDataFrame([(version, at, path, rows)], COMMIT_SCHEMA)
    row.coalesce(1).write.mode("overwrite").json(f"{base}/{COMMITS}/version={version}")
    return version


def version_path(spark: SparkSession, base: str, as_of: dt.datetime | None = None) -> str | None:
    """Folder of the newest snapshot at or before ``as_of``."""
    known = commits(spark, base)
    if as_of is not None:
        known = known.filter(F.col("committed_at") <= F.lit(str(as_of)).cast("timestamp_ntz"))
    newest = known.agg(F.max_by("path", "committed_at").alias("path")).first()
    return newest["path"] if newest else None


def read_as_of(spark: SparkSession, base: str, as_of: dt.datetime | None = None,
               seconds_ago: int = 0, now: dt.datetime | None = None) -> DataFrame:
    """The table as it was at a time, or ``seconds_ago`` before ``now``."""
    if seconds_ago and now is not None:
        as_of = now - dt.timedelta(seconds=seconds_ago)
    path = version_path(spark, base, as_of)
    if path is None:
        raise ValueError(f"{base} has no version at {as_of}")
    return spark.read.parquet(path)


def copy_as_of(spark: SparkSession, base: str, target: str, at: dt.datetime,
               as_of: dt.datetime | None = None) -> int:
    """A real copy of a table, now or as it was, as the next version of ``target``."""
    return write_version(read_as_of(spark, base, as_of), target, at)


def refresh_copies(spark: SparkSession, bases: dict[str, str], at: dt.datetime) -> dict[str, int]:
    """Copies a set of tables, source folder to target folder."""
    return {source: copy_as_of(spark, source, target, at) for source, target in bases.items()}


def _shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], files: int | None = None,
                    partition_by: Sequence[str] = ()) -> None:
    """Range-partitions and sorts by the leading filter columns, so row groups prune well.

    ``files`` are written at least, and more of a large table, so that a task sorts no more as the table grows.
    """
    parts = pieces(df, files or 1)
    ranged = df.repartitionByRange(parts, *columns) if files or parts > _shuffle_partitions(df) else df.repartitionByRange(*columns)
    writer = ranged.sortWithinPartitions(*columns).write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def clustering_report(spark: SparkSession, path: str, column: str) -> DataFrame:
    """Files, mean overlaps and mean depth of the value ranges of the files.

    Ranges are one row per file; overlaps come from counts of range starts and
    ends, not from a join of all pairs: a file overlaps every file that starts
    before its end and has not ended before its start.
    """
    ranges = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(column).alias("lo"), F.max(column).alias("hi"))
    marks = ranges.select(F.explode(F.array(
        F.struct(F.col("lo").alias("at"), F.lit(0).alias("kind"), F.col("file").alias("file")),
        F.struct(F.col("hi").alias("at"), F.lit(1).alias("kind"), F.col("file").alias("file")),
    )).alias("m")).select("m.*")
    upto = Window.orderBy("at", "kind")
    started = F.sum(F.when(F.col("kind") == 0, 1).otherwise(0)).over(upto)
    ended = F.sum(F.when(F.col("kind") == 1, 1).otherwise(0)).over(upto)
    counted = marks.withColumn("started", started).withColumn("ended", ended)
    per_file = counted.groupBy("file").agg(
        F.max(F.when(F.col("kind") == 1, F.col("started"))).alias("started_by_end"),
        F.max(F.when(F.col("kind") == 0, F.col("ended"))).alias("ended_before_start"),
    )
    depth = counted.filter("kind = 0").select((F.col("started") - F.col("ended")).alias("depth"))
    overlaps = F.col("started_by_end") - F.col("ended_before_start") - 1
    return per_file.agg(F.count("*").alias("files"), F.round(F.avg(overlaps), 2).alias("avg_overlaps")).withColumn(
        "avg_depth", depth.agg(F.round(F.avg("depth"), 2)).scalar())


# Versions numbered by a batch, for streams: batch n builds on what was committed before n,
# so a batch that is run again gives the same version again.

BATCH_COMMIT_SCHEMA = "version bigint, part string, path string"


def _batch_commits(spark: SparkSession, base: str, before: int | None) -> DataFrame:
    if not _exists(spark, f"{base}/{COMMITS}"):
        return spark.createDataFrame([], BATCH_COMMIT_SCHEMA)
    known = spark.read.schema(BATCH_COMMIT_SCHEMA).json(f"{base}/{COMMITS}/batch=*")
    return known.filter(F.col("version") < before) if before is not None else known


def part_of(column: str) -> Column:
    """Folder name of a part value."""
    return F.coalesce(F.col(column).cast("string"), F.lit("none"))


def put_batch(df: DataFrame, base: str, version: int, part_column: str | None = None,
              parts: Sequence[str] = ()) -> None:
    """Writes batch ``version``; with ``part_column`` only the parts in ``df`` get a new snapshot.

    Of ``parts`` (names by ``part_of``), those without a row in ``df`` are empty from this version on.
    """
    spark, path = df.sparkSession, f"{base}/data/batch={version}"
    if part_column is None:
        df.write.mode("overwrite").parquet(path, compression=STORED)
        rows = [(version, "all", path)]
    else:
        copy = df.withColumn("_part", part_of(part_column))
        # Rows of a part come together, and a large part is spread over tasks by the size of its rows.
        copy.hint("rebalance", F.col("_part")).write.mode("overwrite").partitionBy("_part").parquet(
            path, compression=STORED)
        # The folders written, not the rows again.
        written = spark.read.schema("_part string").parquet(path)
        found = [r["_part"] for r in written.select("_part").distinct().collect()]
        rows = [(version, str(p), f"{path}/_part={p}") for p in found]
        rows += [(version, p, None) for p in parts if p not in found]
    spark.createDataFrame(rows, BATCH_COMMIT_SCHEMA).coalesce(1).write.mode("overwrite").json(
        f"{base}/{COMMITS}/batch={version}")


def get_batch(spark: SparkSession, base: str, schema: str | None = None, before: int | None = None,
              parts: Sequence[str] | None = None) -> DataFrame | None:
    """The newest snapshot of every part, or None if nothing is committed or all parts are empty."""
    known = _batch_commits(spark, base, before)
    if parts is not None:
        known = known.filter(F.col("part").isin(list(parts)))
    newest = known.groupBy("part").agg(F.max_by("path", "version").alias("path"))
    paths = [r["path"] for r in newest.filter("path IS NOT NULL").collect()]
    if not paths:
        return None
    return (spark.read.schema(schema) if schema else spark.read).parquet(*paths)
