"""Exact interpolated percentiles without gathering a group in one task; any number of them at once.

Equal values are counted first, so a value on most rows is one row from then on. A sketch cuts each group's rows into
stretches of about ``SLACK`` of its rows each; counts per stretch tell which ones hold a wanted rank, and only the values
of those are ordered.
"""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ACCURACY, SLACK = 10_000, 1 / 256


def _same(keys: Sequence[str], prefix: str) -> Column:
    return functools.reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(prefix + k)) for k in keys], F.lit(True))


def exact_percentiles(rows: DataFrame, keys: Sequence[str], value: str, fractions: Mapping[str, float],
                      slices: int | None = None) -> DataFrame:
    """One row per group: for every name the value at rank ``fraction * (n - 1)``, interpolated between neighbours.

    NULL values do not count; a group of NULLs alone has no row. NULL is a key like any other.
    """
    slices = slices or round(1 / SLACK)
    known = rows.filter(F.col(value).isNotNull())
    counts = known.groupBy(*keys, F.col(value).alias("_v")).agg(F.count("*").alias("_n"))
    sketch = known.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(
        F.percentile_approx(value, [i / slices for i in range(1, slices)], ACCURACY).alias("_cuts"), F.count("*").alias("_total"))
    if keys:
        tagged = counts.join(sketch, _same(keys, "_k_")).drop(*[f"_k_{k}" for k in keys])
    else:
        tagged = counts.withColumns({c: sketch.select(c).scalar() for c in ("_cuts", "_total")})
    below = F.size(F.filter("_cuts", lambda c: c < F.col("_v")))
    placed = tagged.withColumn("_slice", below).drop("_cuts")

    # At most ``slices`` rows a group.
    per_slice = placed.groupBy(*keys, "_total", "_slice").agg(F.sum("_n").alias("_n"))
    upto = Window.partitionBy(*keys).orderBy("_slice")
    ends = per_slice.withColumn("_end", F.sum("_n").over(upto)).withColumn("_first", F.col("_end") - F.col("_n"))
    ranks = {name: F.lit(fraction) * (F.col("_total") - 1) for name, fraction in fractions.items()}

    def holds(wanted: Column) -> Column:
        return (F.col("_first") <= wanted) & (wanted < F.col("_end"))

    any_rank = functools.reduce(Column.__or__, [holds(f(rank)) for rank in ranks.values() for f in (F.floor, F.ceil)])
    chosen = ends.filter(any_rank).select(
        *[F.col(k).alias(f"_c_{k}") for k in keys], F.col("_slice").alias("_s"), F.col("_first").alias("_before"))
    within = Window.partitionBy(*keys, "_slice").orderBy("_v")
    ranked = (
        placed.join(chosen, _same(keys, "_c_") & (F.col("_slice") == F.col("_s")))
        .withColumn("_end", F.col("_before") + F.sum("_n").over(within)).withColumn("_first", F.col("_end") - F.col("_n"))
    )
    number = F.col("_v").cast("double")
    found = ranked.groupBy(*keys).agg(*[
        c for name, rank in ranks.items() for c in (
            F.max(F.when(holds(F.floor(rank)), number)).alias(f"_lo_{name}"),
            F.max(F.when(holds(F.ceil(rank)), number)).alias(f"_hi_{name}"),
            F.max(rank - F.floor(rank)).alias(f"_part_{name}"))])
    low = lambda name: F.col(f"_lo_{name}")
    return found.select(*keys, *[
        (low(name) + (F.col(f"_hi_{name}") - low(name)) * F.col(f"_part_{name}")).alias(name) for name in fractions])


def exact_percentile(rows: DataFrame, keys: Sequence[str], value: str, fraction: float, out: str) -> DataFrame:
    return exact_percentiles(rows, keys, value, {out: fraction})


def exact_median(rows: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    return exact_percentile(rows, keys, value, 0.5, out)
