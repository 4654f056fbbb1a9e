"""Tables kept in buckets of a key's hash, so that a small change rewrites few of them."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.sources import sinks

BUCKETS = 64
FIRST = "_first"


def bucket_of(keys: Sequence[str], buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def is_new(base: str, rows: DataFrame, version: int) -> bool:
    return sinks._batch_commits(rows.sparkSession, base, version).isEmpty()


def merge_buckets(rows: DataFrame, base: str, keys: Sequence[str], initial: DataFrame,
                  merge: Callable[[DataFrame, DataFrame], DataFrame], version: int, buckets: int = BUCKETS) -> list[str]:
    """Version ``version`` of a table: ``merge(target, rows)`` for the buckets that hold a key of ``rows``, the others as
    they were. The first version holds ``initial`` in all buckets. Gives the buckets written.

    ``merge`` must treat each key by itself and leave keys as they are; a null key is a key.
    """
    spark = rows.sparkSession
    touched = sorted(str(r[0]) for r in rows.select(bucket_of(keys, buckets)).distinct().collect())
    if is_new(base, rows, version):
        target, touched = initial, [str(b) for b in range(buckets)]
    elif not touched:
        return []
    else:
        stored = sinks.get_batch(spark, base, before=version, parts=touched)
        target = initial.limit(0) if stored is None else stored.select(*initial.columns)
    merged = merge(target, rows).withColumn("_bucket", bucket_of(keys, buckets))
    sinks.put_batch(merged, base, version, "_bucket", touched)
    return touched


def first_key(base: str, initial: DataFrame, surrogate: str) -> int:
    """The number above which a bucketed table gives keys: the largest of its first rows, noted once."""
    spark, path = initial.sparkSession, f"{base}/{FIRST}"
    if not sinks._exists(spark, f"{path}/_SUCCESS"):
        initial.agg(F.coalesce(F.max(surrogate), F.lit(0)).cast("bigint").alias("first")).coalesce(1).write.mode(
            "overwrite").json(path)
    return spark.read.schema("first bigint").json(path).first()[0]


def add_keys(rows: DataFrame, known: DataFrame, key: str, natural: str, first: int, buckets: int = BUCKETS) -> DataFrame:
    """Surrogate keys for new rows from what their own buckets hold in ``known``.

    Bucket b gives first + b + 1, first + b + 1 + buckets, and so on, so no two buckets give the same key.
    """
    bucket = bucket_of([natural], buckets)
    given = F.greatest(F.max(key) - F.lit(first), F.lit(0))
    used = known.groupBy(bucket.alias("_b")).agg(F.ceil(given / buckets).alias("_used"))
    row = F.row_number().over(Window.partitionBy("_bucket").orderBy(natural))
    numbered = rows.withColumn("_bucket", bucket).withColumn("_row", row).join(F.broadcast(used), F.col("_bucket") == F.col("_b"), "left")
    value = F.lit(first) + (F.coalesce("_used", F.lit(0)) + F.col("_row") - 1) * buckets + F.col("_bucket") + 1
    return numbered.withColumn(key, value.cast("bigint")).drop("_bucket", "_row", "_b", "_used")
