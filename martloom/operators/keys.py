"""Joins by key, orphan checks and key generation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Memory that a table may take for each byte of its compressed files.
UNPACKED = 3


def source_bytes(df: DataFrame) -> int | None:
    """Size of the tables a DataFrame reads, or None if Spark does not say.

    Spark's own estimate of a joined dimension multiplies its inputs; for a
    dimension looked up row by row the sum of the inputs is the fair bound. A
    remote session does not say; an error of a local one is shown.
    """
    plan = getattr(df, "_jdf", None)
    if plan is None:
        return None
    leaves = plan.queryExecution().analyzed().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def small_side(df: DataFrame) -> DataFrame:
    """Broadcast hint for a dimension whose source tables, unpacked, are under the session's broadcast threshold.

    Above it there is no hint: Spark joins by shuffle and AQE splits skewed partitions.
    """
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760").lower().rstrip("b")
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    limit = int(text[:-1]) * units[text[-1]] if text[-1] in units else int(text)
    size = source_bytes(df)
    return F.broadcast(df) if size is not None and size * UNPACKED <= limit else df


#: Bytes of source files for a task that holds or writes all of its rows.
PIECE = 8 << 20


def pieces(df: DataFrame, least: int = 1) -> int:
    """Parts in which ``df`` is dealt out so that a part keeps its size as the tables grow; ``least`` if Spark does not say."""
    size = source_bytes(df)
    return max(least, -(-size // PIECE)) if size is not None and size < 1 << 60 else least


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Rows dealt out by ``columns`` in parts of even source size, whatever the session's number of shuffle partitions.

    A grouping by these and further columns finds its rows there and needs no shuffle of its own.
    """
    parts = pieces(df)
    return df.repartition(parts, *columns) if parts > 1 else df


def lookup(fact: DataFrame, dimension: DataFrame, on: Column | str | list[str], columns: Sequence[str],
           condition: str | None = None) -> DataFrame:
    """Left lookup of ``columns``; ``condition`` restricts the dimension before the join."""
    side = dimension.filter(condition) if condition else dimension
    if isinstance(on, Column):
        return fact.join(side, on, "left").select(*[fact[c] for c in fact.columns], *[side[c] for c in columns])
    names = [on] if isinstance(on, str) else list(on)
    return fact.join(side.select(*names, *columns), names, "left")


def orphan_rows(rows: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose key is set but has no parent."""
    return rows.filter(F.col(key).isNotNull()).join(parent.select(key), key, "left_anti")


def orphan_count(rows: DataFrame, parent: DataFrame, key: str, nulls_count: bool = False) -> DataFrame:
    """One row ``checked, orphans``. Counts per key come first, so a hot key costs one row in the join."""
    per_key = rows.groupBy(key).agg(F.count("*").alias("_n"))
    if not nulls_count:
        per_key = per_key.filter(F.col(key).isNotNull())
    known = parent.select(F.col(key).alias("_k")).distinct()
    joined = per_key.join(known, F.col(key) == F.col("_k"), "left")
    return joined.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("checked"),
        F.coalesce(F.sum(F.when(F.col("_k").isNull(), F.col("_n"))), F.lit(0)).alias("orphans"),
    )


def key_counts(rows: DataFrame, kinds: dict[str, Sequence[str]], marks: dict[str, Column] | None = None) -> DataFrame:
    """(kind, k1, k2, n): rows per key of several kinds of keys, of one or two columns each, from one pass.

    ``marks`` are kinds without a key: n counts the rows for which the condition is true. Keys are compared as text.
    """
    def one(kind: str, columns: Sequence[str]) -> Column:
        texts = [F.col(c).cast("string") for c in columns] + [F.lit(None).cast("string")] * (2 - len(columns))
        return F.struct(F.lit(kind).alias("kind"), texts[0].alias("k1"), texts[1].alias("k2"))

    found = [one(kind, columns) for kind, columns in kinds.items()]
    found += [F.when(condition, one(kind, ())) for kind, condition in (marks or {}).items()]
    stacked = rows.select(F.explode(F.array_compact(F.array(*found))).alias("s")).select("s.*")
    return stacked.groupBy("kind", "k1", "k2").agg(F.count("*").alias("n"))


def orphan_counts(counts: DataFrame, parents: dict[str, tuple[DataFrame, str, bool]]) -> DataFrame:
    """One row with ``checked_<kind>`` and ``orphans_<kind>`` for every kind, from ``key_counts``.

    ``parents`` has for each kind the parent, its key and whether a null key is an orphan. All parents' keys meet the
    counted keys in one join, in which a hot key is one row.
    """
    known, out = None, []
    for kind, (parent, key, _) in parents.items():
        part = parent.select(F.lit(kind).alias("_kind"), F.col(key).cast("string").alias("_k")).filter("_k IS NOT NULL")
        known = part if known is None else known.unionByName(part)
    met = counts.filter(F.col("kind").isin(list(parents))).join(
        known.distinct(), (F.col("kind") == F.col("_kind")) & (F.col("k1") == F.col("_k")), "left")
    for kind, (_, _, nulls_count) in parents.items():
        own = F.col("kind") == kind if nulls_count else (F.col("kind") == kind) & F.col("k1").isNotNull()
        out += [F.coalesce(F.sum(F.when(own, F.col("n"))), F.lit(0)).alias(f"checked_{kind}"),
                F.coalesce(F.sum(F.when(own & F.col("_k").isNull(), F.col("n"))), F.lit(0)).alias(f"orphans_{kind}")]
    return met.agg(*out)


def semi(rows: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.join(wanted.select(*keys), list(keys), "left_semi")


def not_in(rows: DataFrame, unwanted: DataFrame, key: str) -> DataFrame:
    """NOT IN over the non-null keys of ``unwanted``; a NULL among them does not empty the result."""
    return rows.filter(F.col(key).isNotNull()).join(
        unwanted.filter(F.col(key).isNotNull()).select(key), key, "left_anti"
    )


def attach_scalars(rows: DataFrame, totals: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns of a one-row table on every row, as scalar subqueries (no cross join)."""
    return rows.withColumns({c: totals.select(c).scalar() for c in columns or totals.columns})


def duplicates(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("cnt")).filter("cnt > 1")


def latest_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key under ``order``.

    Spark cuts each task's rows to one per key before the shuffle (window group
    limit), so a hot key sends one row per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def top_per_group(rows: DataFrame, group: Sequence[str], order: Sequence[Column], n: int,
                  value: Column) -> DataFrame:
    """Row and dense rank per group, the first ``n`` rows kept; dense rank looks at ``value`` alone.

    The rows are cut to ``n`` per group before the dense rank is taken, which
    leaves it unchanged: rows with a better value come earlier in ``order``.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    first = rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
    return first.withColumn("dense_rank", F.dense_rank().over(Window.partitionBy(*group).orderBy(value)))


def slice_of(key: Column, slices: int) -> Column:
    """Even, replay-safe slice number of a unique key."""
    return F.pmod(F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint"), F.lit(slices))


def add_keys(rows: DataFrame, key: str, natural: str, start: Column | int, slices: int = 64) -> DataFrame:
    """Unique surrogate keys above ``start`` for rows with a unique ``natural`` key.

    Each slice numbers its own rows and steps by ``slices``, so no window spans
    the table; the same rows always get the same keys. Keys leave small gaps.
    """
    slot = slice_of(F.col(natural), slices)
    w = Window.partitionBy("_slice").orderBy(natural)
    numbered = rows.withColumn("_slice", slot).withColumn("_row", F.row_number().over(w))
    value = (F.lit(start) if isinstance(start, int) else start) + (F.col("_row") - 1) * slices + F.col("_slice") + 1
    return numbered.withColumn(key, value.cast("bigint")).drop("_slice", "_row")


def union_counts(parts: dict[str, DataFrame], label: str = "table_name", count: str = "row_count") -> DataFrame:
    """UNION ALL of labelled row counts."""
    out = None
    for name, df in parts.items():
        one = df.agg(F.count("*").alias(count)).select(F.lit(name).alias(label), count)
        out = one if out is None else out.unionByName(one)
    return out
