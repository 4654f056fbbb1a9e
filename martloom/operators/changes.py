"""Changes between two keyed snapshots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.hashing import row_digest
from martloom.functions.measures import count_if

INSERT, DELETE = "INSERT", "DELETE"
META = ("action", "is_update", "row_id")


def _with_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    for k in keys:
        rows = rows.filter(F.col(k).isNotNull())
    return rows


def _keyed(df: DataFrame, keys: Sequence[str], columns: Sequence[str], tag: str) -> DataFrame:
    return _with_keys(df, keys).select(
        *[F.col(k).alias(f"_{tag}_{k}") for k in keys],
        F.struct(*columns).alias(f"_{tag}"),
        row_digest(df, columns).alias(f"_{tag}_hash"),
    )


def diff(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inserts, deletes, and updates as a delete and an insert with ``is_update``.

    One shuffle of each snapshot on its key; the compare is one digest per row.
    Rows with a NULL key are left out.
    """
    columns = old.columns
    before, after = _keyed(old, keys, columns, "old"), _keyed(new, keys, columns, "new")
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(f"_old_{k}") == F.col(f"_new_{k}"))
    changed = before.join(after, same, "full").filter(~F.col("_old_hash").eqNullSafe(F.col("_new_hash")))
    row_id = F.md5(F.concat_ws("|", *[F.coalesce(f"_new_{k}", f"_old_{k}").cast("string") for k in keys]))
    both = F.col("_old_hash").isNotNull() & F.col("_new_hash").isNotNull()
    sides = F.filter(
        F.array(
            F.struct(F.lit(DELETE).alias("action"), F.col("_old").alias("row"), F.col("_old_hash").alias("h")),
            F.struct(F.lit(INSERT).alias("action"), F.col("_new").alias("row"), F.col("_new_hash").alias("h")),
        ),
        lambda side: side["h"].isNotNull(),
    )
    rows = changed.select(row_id.alias("row_id"), both.alias("is_update"), F.explode(sides).alias("_s"))
    return rows.select(*[F.col("_s.row")[c].alias(c) for c in columns], F.col("_s.action").alias("action"),
                       "is_update", "row_id")


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _digests(df: DataFrame, keys: Sequence[str], columns: Sequence[str], buckets: int) -> DataFrame:
    """Per bucket of the key's hash: rows, and two sums over independent digests of each row."""
    row = F.struct(*columns)
    high = F.conv(F.substring(F.md5(F.to_json(row, {"ignoreNullFields": "false"})), 1, 15), 16, 10).cast("decimal(20,0)")
    return _with_keys(df, keys).groupBy(_bucket(keys, buckets).alias("bucket")).agg(
        F.count("*").alias("n"), F.sum(F.xxhash64(row).cast("decimal(20,0)")).alias("a"), F.sum(high).alias("b"))


def changed_buckets(old: DataFrame, new: DataFrame, keys: Sequence[str], buckets: int = 1024) -> list[int]:
    """Buckets of the key's hash in which two snapshots differ: one scan of each, at most ``buckets`` rows in the join."""
    columns = old.columns
    before, after = (_digests(df, keys, columns, buckets).select(
        "bucket", F.struct("n", "a", "b").alias(tag)) for df, tag in ((old, "before"), (new, "after")))
    met = before.join(after, "bucket", "full").filter(~F.col("before").eqNullSafe(F.col("after")))
    return sorted(r["bucket"] for r in met.select("bucket").collect())


def diff_by_digest(old: DataFrame, new: DataFrame, keys: Sequence[str], buckets: int = 1024) -> DataFrame:
    """``diff`` for snapshots that differ little: rows are joined in the buckets whose digests differ, and nowhere else.

    Snapshots that are equal cost a scan of each and no join of rows.
    """
    found = changed_buckets(old, new, keys, buckets)
    if not found:
        return diff(old.limit(0), new.limit(0), keys)
    if len(found) == buckets:
        return diff(old, new, keys)
    some = _bucket(keys, buckets).isin(found)
    return diff(old.filter(some), new.filter(some), keys)


def apply(old: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The snapshot after the changes."""
    columns = old.columns
    added = changes.filter(F.col("action") == INSERT).select(*columns)
    return old.join(changes.select(*keys).distinct(), list(keys), "left_anti").select(*columns).unionByName(added)


def summary(changes: DataFrame, name: str) -> DataFrame:
    update = F.col("is_update")
    return changes.agg(
        F.count("*").alias("total_changes"),
        count_if((F.col("action") == INSERT) & ~update).alias("inserts"),
        F.floor(count_if(update) / 2).alias("updates"),
        count_if((F.col("action") == DELETE) & ~update).alias("deletes"),
    ).select(F.lit(name).alias("stream_name"), "total_changes", "inserts", "updates", "deletes")


def has_data(streams: Mapping[str, DataFrame]) -> DataFrame:
    """Per stream: is a change pending? Looks at one row of each."""
    out = None
    for name, rows in streams.items():
        one = rows.limit(1).agg((F.count("*") > 0).alias("has_data")).select(
            F.lit(name).alias("stream_name"), "has_data")
        out = one if out is None else out.unionByName(one)
    return out


def before_after(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Updates as pairs of old and new values."""
    values = [c for c in changes.columns if c not in (*META, *keys)]
    updates = changes.filter("is_update")
    return updates.groupBy("row_id", *keys).agg(
        F.max(F.when(F.col("action") == DELETE, F.struct(*values))).alias("before"),
        F.max(F.when(F.col("action") == INSERT, F.struct(*values))).alias("after"),
    )
