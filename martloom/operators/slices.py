"""Windows over raw rows whose key may be hot.

A key with more than ``limit`` rows is cut into equal-depth slices along the
window order, as many as keep a slice of the largest key under the limit; the
window runs per (key, slice) and a small per-slice summary carries totals across
slices. Ordinary keys keep one slice, and without a hot key nothing is joined.
All rows stay in the result; NULL is a key like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOT_ROWS = 4_000_000


def _joined(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """A join in which NULL equals NULL; the keys are the left ones."""
    other = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(other, on, how).drop(*[f"_r_{k}" for k in keys])


def _parts(rows: DataFrame, keys: Sequence[str], limit: int) -> int:
    """Slices that the largest key needs; 0 if no key is hot."""
    most = rows.groupBy(*keys).agg(F.count("*").alias("_n")).agg(F.max("_n")).first()[0] or 0
    return 0 if most <= limit else -(-most // limit) + 1


def _bounds(rows: DataFrame, keys: Sequence[str], positions: dict[str, Column], limit: int, parts: int) -> DataFrame:
    """Equal-depth bounds of each hot key. At most row_count / limit keys are hot."""
    fractions = [i / parts for i in range(1, parts)]
    per_key = rows.groupBy(*keys).agg(F.count("*").alias("_n"), *[
        F.percentile_approx(position, fractions, parts * 100).alias(f"_b_{name}")
        for name, position in positions.items()
    ])
    return per_key.filter(F.col("_n") > limit).drop("_n")


def slice_hot(rows: DataFrame, keys: Sequence[str], position: Column, limit: int = HOT_ROWS,
              parts: int | None = None) -> DataFrame:
    """Adds ``_slice``: 0 for ordinary keys, else the number of bounds at or below ``position`` plus one."""
    parts = _parts(rows, keys, limit) if parts is None else parts
    if not parts:
        return rows.withColumn("_slice", F.lit(0))
    joined = _joined(rows, _bounds(rows, keys, {"p": position}, limit, parts), keys).withColumn("_pos", position)
    index = F.size(F.expr("filter(_b_p, b -> b <= _pos)")) + 1
    return joined.withColumn("_slice", F.when(F.col("_b_p").isNull(), 0).otherwise(index)).drop("_b_p", "_pos")


def slice_hot_with_ties(rows: DataFrame, keys: Sequence[str], value: Column, tie: Column,
                        limit: int = HOT_ROWS, parts: int | None = None) -> DataFrame:
    """Slices for a descending ``value``, ties broken by ascending ``tie``.

    A value that fills whole slices alone (equal bounds) is cut again along ``tie``.
    """
    parts = _parts(rows, keys, limit) if parts is None else parts
    if not parts:
        return rows.withColumn("_slice", F.lit(0))
    bounds = _bounds(rows, keys, {"v": value, "t": tie}, limit, parts)
    joined = _joined(rows, bounds, keys).withColumn("_val", value).withColumn("_tie", tie)
    above = F.size(F.expr("filter(_b_v, b -> b > _val)"))
    heavy = F.size(F.expr("filter(_b_v, b -> b = _val)")) > 1
    inner = F.when(heavy, F.size(F.expr("filter(_b_t, b -> b <= _tie)")) + 1).otherwise(0)
    number = above * (parts + 1) + inner + 1
    return joined.withColumn("_slice", F.when(F.col("_b_v").isNull(), 0).otherwise(number)).drop(
        "_b_v", "_b_t", "_val", "_tie"
    )


def carry(rows: DataFrame, keys: Sequence[str], total: Column, out: str) -> DataFrame:
    """Per hot (key, slice): sum of ``total`` over the earlier slices of the key."""
    w = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    per_slice = rows.filter("_slice > 0").groupBy(*keys, "_slice").agg(total.alias("_t"))
    return per_slice.select(*keys, "_slice", F.coalesce(F.sum("_t").over(w), F.lit(0)).alias(out))


def rank_descending(rows: DataFrame, keys: Sequence[str], value: str, ties: Sequence[str], out: str,
                    limit: int = HOT_ROWS, parts: int | None = None) -> DataFrame:
    """ROW_NUMBER per key by descending ``value``, then ``ties`` ascending (the first tie is numeric)."""
    cut = slice_hot_with_ties(rows, keys, F.col(value), F.col(ties[0]), limit, parts)
    order = [F.col(value).desc_nulls_last(), *[F.col(t).asc_nulls_first() for t in ties]]
    local = cut.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys, "_slice").orderBy(*order)))
    before = carry(cut, keys, F.count("*"), "_before")
    return (
        _joined(local, before, [*keys, "_slice"])
        .withColumn(out, (F.col("_rn") + F.coalesce("_before", F.lit(0))).cast("bigint"))
        .drop("_rn", "_before", "_slice")
    )


def running_total(rows: DataFrame, keys: Sequence[str], period: str, value: str, out: str) -> DataFrame:
    """Running total per key by ``period``; rows of one period share it.

    Sums per (key, period) come first, so the window sees one row per period.
    """
    per_period = rows.groupBy(*keys, period).agg(F.sum(value).alias("_s"))
    w = Window.partitionBy(*keys).orderBy(period)
    totals = per_period.select(*keys, period, F.sum("_s").over(w).alias(out))
    return _joined(rows, totals, [*keys, period])


def _with_previous(cut: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str) -> DataFrame:
    """LAG of ``value`` per key, across slices: the first row of a slice looks at the last of the slice before."""
    local = Window.partitionBy(*keys, "_slice").orderBy(*order)
    last = (
        cut.filter("_slice > 0").groupBy(*keys, "_slice")
        .agg(F.max(F.struct(*order, F.col(value).alias("_v"))).alias("_last"))
    )
    across = Window.partitionBy(*keys).orderBy("_slice")
    edges = last.select(*keys, "_slice", F.lag(F.col("_last._v")).over(across).alias("_edge"))
    seen = cut.withColumn("_row", F.row_number().over(local)).withColumn("_lag", F.lag(value).over(local))
    return (
        _joined(seen, edges, [*keys, "_slice"])
        .withColumn(out, F.when(F.col("_row") == 1, F.col("_edge")).otherwise(F.col("_lag")))
        .drop("_row", "_lag", "_edge")
    )


def last_version(rows: DataFrame, keys: Sequence[str], day: str, version: str, until: str, out: str,
                 limit: int = HOT_ROWS, parts: int | None = None) -> DataFrame:
    """Adds ``out``: the last non-null ``version`` per key up to each row's ``day``, in one ordered pass.

    ``version`` is a struct with a field ``until``; versions stand before the other rows of their day, the one that
    lasts longest last. Rows of a day among themselves need no order, so a day that fills slices is cut by row hash.
    The last version of a slice is carried into the slices after it.
    """
    parts = _parts(rows, keys, limit) if parts is None else parts
    new = F.col(version).isNotNull()
    rest = [c for c in rows.columns if c != version]
    tie = F.when(new, F.lit(-1).cast("long")).otherwise(F.pmod(F.xxhash64(*rest), F.lit(1 << 30)))
    cut = slice_hot_with_ties(rows, keys, -F.unix_date(day), tie, limit, parts)
    order = [F.col(day), F.col(version).isNull(), F.col(f"{version}.{until}")]
    local = Window.partitionBy(*keys, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    seen = cut.withColumn(out, F.last(version, ignorenulls=True).over(local))
    if not parts:
        return seen.drop("_slice")
    place = F.when(new, F.struct(F.col(day), F.col(f"{version}.{until}")))
    last = cut.filter("_slice > 0").groupBy(*keys, "_slice").agg(F.max_by(version, place).alias("_v"))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    edges = last.select(*keys, "_slice", F.last("_v", ignorenulls=True).over(before).alias("_edge"))
    return (
        _joined(seen, edges, [*keys, "_slice"])
        .withColumn(out, F.coalesce(out, "_edge"))
        .drop("_edge", "_slice")
    )


def _running_count(cut: DataFrame, keys: Sequence[str], order: Sequence[str], flag: str, out: str) -> DataFrame:
    local = Window.partitionBy(*keys, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = carry(cut, keys, F.sum(flag), "_before")
    return (
        _joined(cut.withColumn("_c", F.sum(flag).over(local)), before, [*keys, "_slice"])
        .withColumn(out, (F.col("_c") + F.coalesce("_before", F.lit(0))).cast("bigint"))
        .drop("_c", "_before")
    )


def sessionize(events: DataFrame, user: str, ts: str, tie: str, gap_minutes: int = 30,
               limit: int = HOT_ROWS, parts: int | None = None) -> DataFrame:
    """Adds ``session_number`` from 1: a new session after more than ``gap_minutes`` without an event.

    The gap counts minute boundaries.
    """
    from martloom.functions.dates import minutes_crossed

    cut = slice_hot(events, [user], F.unix_micros(F.col(ts).cast("timestamp")), limit, parts)
    seen = _with_previous(cut, [user], [ts, tie], ts, "_prev")
    new = F.col("_prev").isNull() | (minutes_crossed(F.col("_prev"), F.col(ts)) > gap_minutes)
    counted = _running_count(seen.withColumn("_new", new.cast("int")), [user], [ts, tie], "_new", "session_number")
    return counted.drop("_prev", "_new", "_slice")


def change_count(rows: DataFrame, key: str, ts: str, tie: str, value: str, out: str = "change_number",
                 limit: int = HOT_ROWS, parts: int | None = None) -> DataFrame:
    """Running count of changes of ``value`` per key; NULLs do not count as a change."""
    cut = slice_hot(rows, [key], F.unix_micros(F.col(ts).cast("timestamp")), limit, parts)
    seen = _with_previous(cut, [key], [ts, tie], value, "_prev")
    changed = F.coalesce((F.col(value) != F.col("_prev")).cast("int"), F.lit(0))
    return _running_count(seen.withColumn("_new", changed), [key], [ts, tie], "_new", out).drop(
        "_prev", "_new", "_slice"
    )
