"""Streams that keep dimension and fact tables, batch by batch."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from martloom.operators import dimensions, facts
from martloom.sources import buckets, keymap
from martloom.streaming.ingest import per_batch


def clickstream_fact(staged: DataFrame, calendar: Callable[[], DataFrame], customer: Callable[[], DataFrame], out: str,
                     checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Fact rows of each batch, looked up in the dimensions as they are when the batch runs."""
    def write(rows: DataFrame, batch_id: int) -> None:
        facts.load_clickstream(rows, calendar(), customer()).write.mode("overwrite").parquet(
            f"{out}/batch_id={batch_id}")

    return per_batch(staged, checkpoint, write, trigger)


def keep_scd1(changes: DataFrame, base: str, initial: DataFrame, keys: Sequence[str], set_columns: Sequence[str],
              order: Sequence[Column], checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Overwrite dimension in buckets of its keys: each batch rewrites the buckets of the keys it holds."""
    def write(rows: DataFrame, batch_id: int) -> None:
        merge = lambda target, rows: dimensions.overwrite_merge(target, rows, keys, set_columns, order=order)
        buckets.merge_buckets(rows, base, keys, initial, merge, batch_id)

    return per_batch(changes, checkpoint, write, trigger)


def keep_scd2(changes: DataFrame, base: str, initial: DataFrame, key: str, hash_column: str, surrogate: str,
              as_of: Callable[[int], dt.date], order: Sequence[Column], checkpoint: str,
              trigger: dict | None = None) -> StreamingQuery:
    """History-keeping dimension in buckets of its key; ``as_of`` dates a batch by its number, so a replay dates it alike.

    New surrogate keys are numbered within each bucket, above the keys the dimension began with.
    """
    def write(rows: DataFrame, batch_id: int) -> None:
        first = buckets.first_key(base, initial, surrogate)

        def merge(target: DataFrame, rows: DataFrame) -> DataFrame:
            return dimensions.scd2_load(target, rows, key, hash_column, as_of(batch_id), surrogate, order,
                                        number=lambda fresh: buckets.add_keys(fresh, target, surrogate, key, first))

        buckets.merge_buckets(rows.filter(rows[key].isNotNull()), base, [key], initial, merge, batch_id)

    return per_batch(changes, checkpoint, write, trigger)


def keep_facts(rows: DataFrame, base: str, keys: Sequence[str], order: Sequence[Column], part: str, checkpoint: str,
               trigger: dict | None = None) -> StreamingQuery:
    """Facts placed by their own date, however late: only the ``part`` values that keys enter or leave are rewritten."""
    def write(batch: DataFrame, batch_id: int) -> None:
        keymap.upsert_parts(batch, base, keys, order, part, batch_id)

    return per_batch(rows, checkpoint, write, trigger)
