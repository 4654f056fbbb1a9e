"""Session settings and the shared scratch folder."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


_own: dict[str, str] = {}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g",
                  app: str = "martloom", settings: dict[str, str] | None = None) -> SparkSession:
    """A session for tests and the benchmark; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in (settings or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    If that is unset, a session that runs in one process gets a folder of its own; on a cluster it must be set.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _own:
        _own[context.applicationId] = tempfile.mkdtemp(prefix="martloom-")
    return _own[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the session's own part of the shared folder."""
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"


def clean_scratch(spark: SparkSession) -> None:
    """Deletes what this session has written by ``scratch_path``; results that still read it are gone with it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Whether a query's shuffle files go when it ends; otherwise they stay until the driver happens to collect its garbage.
_FREES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """Queries that begin and end in here leave no shuffle files, so a job of many steps needs the disk of its largest."""
    before = spark.conf.get(_FREES, None)
    spark.conf.set(_FREES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREES)
        else:
            spark.conf.set(_FREES, before)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Writes a result that several steps read to the shared folder, once, and reads it from there.

    The files outlive the executors that wrote them, so a lost executor costs no recomputation.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    with freed(spark):
        df.write.parquet(path)
    result = spark.read.schema(df.schema).parquet(path)
    result._written = path
    return result


def release(*results: DataFrame) -> None:
    """Deletes what ``materialise`` has written for results that no step reads any more."""
    for df in results:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._written)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
