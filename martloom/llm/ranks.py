"""Row numbers and running totals within keys of which one may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows that a slice of a key holds, about, if the key held every row.
SLICE_ROWS = 100_000
LEAST_SLICES = 64


def slice_count(rows: int) -> int:
    return LEAST_SLICES + rows // SLICE_ROWS


def digest(name: str, *others: str) -> Column:
    """A 32-bit number from a column's text, the same in every engine that has md5; where it is null, from the others."""
    rest = F.xxhash64(*others).cast("string") if others else F.lit("")
    return F.conv(F.substring(F.md5(F.coalesce(F.col(name).cast("string"), rest)), 1, 8), 16, 10).cast("long")


def ranked(df: DataFrame, keys: list[str], ties: list[str], rows: int, out: str = "rank") -> DataFrame:
    """Numbers the rows of each key from 0: by slice of the key, and in it by ``ties``.

    A key is cut into slices by a digest of the first of ``ties``, or of the others where that is null; slices are numbered by windows and moved up by the
    sizes of the slices before. ``df`` is read twice, so it should be a written table. Null keys are one key.
    """
    names = [f"_key{i}" for i in range(len(keys))]
    cut = df.select("*", F.pmod(digest(*ties), F.lit(slice_count(rows))).cast("int").alias("_slice"),
                    *[F.xxhash64(k).alias(n) for k, n in zip(keys, names)])
    sizes = cut.groupBy(*names, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*names).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*names, "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(*names, "_slice").orderBy(*ties)) - 1
    return (cut.withColumn("_inside", inside).join(sizes, [*names, "_slice"])
            .withColumn(out, F.col("_before") + F.col("_inside"))
            .drop(*names, "_slice", "_before", "_inside"))
