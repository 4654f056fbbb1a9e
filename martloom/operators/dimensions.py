"""Dimension and fact merges over plain DataFrames.

A merge reads the old version and returns the new one; writing it as the next
version is up to the caller (see ``sources.sinks``). A source is cut to one row
per key before it is joined, so keys are unique on both sides.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions import bands
from martloom.functions import dates as D
from martloom.operators.keys import add_keys, latest_per_key
from martloom.operators.slices import HOT_ROWS, last_version

UNKNOWN_KEY = -1


def overwrite_merge(target: DataFrame, source: DataFrame, keys: Sequence[str], set_columns: Sequence[str],
                    changed: Column | None = None, order: Sequence[Column] | None = None,
                    inserts: DataFrame | None = None) -> DataFrame:
    """Update matched rows, insert the rest, in one full join.

    ``changed`` (over ``t_`` and ``s_`` columns) limits the update; ``order`` picks
    one source row per key; columns missing in the source stay as they are, and
    are NULL in an inserted row.
    """
    if order:
        source = latest_per_key(source, keys, order)
    have = set(source.columns)
    t = target.select(*[F.col(c).alias(f"t_{c}") for c in target.columns], F.lit(True).alias("t_"))
    s = source.select(*[F.col(c).alias(f"s_{c}") for c in source.columns], F.lit(True).alias("s_"))
    match = F.lit(True)
    for k in keys:
        match = match & (F.col(f"t_{k}") == F.col(f"s_{k}"))
    update = F.col("s_").isNotNull() & (F.coalesce(changed, F.lit(False)) if changed is not None else F.lit(True))
    new = F.col("t_").isNull()

    def value(c: str) -> Column:
        if c not in have:
            return F.col(f"t_{c}")
        take = new | update if (c in set_columns or c in keys) else new
        return F.when(take, F.col(f"s_{c}")).otherwise(F.col(f"t_{c}"))

    return t.join(s, match, "full").select(*[value(c).alias(c) for c in target.columns])


def with_new_keys(rows: DataFrame, key: str, natural: str, slices: int = 64) -> DataFrame:
    """Gives a surrogate key above the present maximum to rows that have none."""
    start = F.coalesce(rows.agg(F.max(key)).scalar(), F.lit(0))
    fresh = rows.filter(F.col(key).isNull()).drop(key)
    kept = rows.filter(F.col(key).isNotNull())
    return kept.unionByName(add_keys(fresh, key, natural, start, slices).select(*kept.columns))


# Product and store

# Columns overwritten by a product change.
PRODUCT_SET = (
    "product_name", "description", "category", "subcategory", "brand", "unit_cost", "unit_price", "profit_margin",
    "weight_kg", "dimensions", "is_active", "launch_date", "discontinue_date", "attributes",
)
# Columns overwritten by a store change, and the ones staging may lack.
STORE_SET = (
    "store_name", "store_type", "store_format", "address", "city", "state", "postal_code", "country", "region",
    "latitude", "longitude", "manager_name", "phone", "email", "open_date", "close_date", "square_footage",
    "is_active",
)
STORE_OPTIONAL = {
    "store_format": "string", "address": "string", "postal_code": "string", "latitude": "decimal(10,7)",
    "longitude": "decimal(10,7)", "manager_name": "string", "phone": "string", "email": "string",
    "open_date": "date", "close_date": "date", "square_footage": "int",
}


def profit_margin(price: Column, cost: Column) -> Column:
    zero = F.lit(0).cast("decimal(5,2)")
    share = F.round((price - cost) / F.nullif(price, price * 0) * 100, 2).cast("decimal(5,2)")
    return F.when(price > 0, share).otherwise(zero)


def load_product(target: DataFrame, changes: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Overwrite by product id; the margin is computed here."""
    source = changes.withColumn("profit_margin", profit_margin(F.col("unit_price"), F.col("unit_cost")))
    merged = overwrite_merge(target, source, ["product_id"], PRODUCT_SET, order=order)
    return with_new_keys(merged, "product_key", "product_id")


def load_store(target: DataFrame, staged: DataFrame, order: Sequence[Column] | None = None) -> DataFrame:
    """Overwrite by store id; the region follows from the state."""
    source = staged.withColumn("region", bands.region_of(F.col("state"), bands.STORE_REGIONS))
    for name, kind in STORE_OPTIONAL.items():
        if name in target.columns and name not in source.columns:
            source = source.withColumn(name, F.lit(None).cast(kind))
    merged = overwrite_merge(target, source, ["store_id"], STORE_SET, order=order)
    return with_new_keys(merged, "store_key", "store_id")


# Customer history

def enrich_customer(staged: DataFrame, as_of: dt.date) -> DataFrame:
    """Derived columns of a customer version."""
    return (
        staged.withColumn("full_name", F.concat(F.col("first_name"), F.lit(" "), F.col("last_name")))
        .withColumn("age_group", bands.age_group(F.col("date_of_birth"), D.day(as_of)))
        .withColumn("loyalty_tier", bands.loyalty_tier(F.col("loyalty_points")))
        .withColumn("region", bands.region_of(F.col("state")))
    )


def scd2_load(dimension: DataFrame, changes: DataFrame, key: str, hash_column: str, as_of: dt.date,
              surrogate: str, order: Sequence[Column] | None = None, slices: int = 64,
              number: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Next version of a history-keeping dimension.

    Only the current rows meet the changes, on the key. A changed current row is
    closed the day before ``as_of`` and a new version opens; a current row that
    opened on ``as_of`` itself is overwritten instead, so no version ends before
    it starts. The same load again changes nothing. Rows of ``changes`` are cut
    to one per key (by ``order``). ``number`` gives new rows their surrogate key, above the present maximum by default.
    """
    today = D.day(as_of)
    columns = dimension.columns
    source = changes.filter(F.col(key).isNotNull())
    source = latest_per_key(source, [key], order or [F.col(hash_column)])
    source = source.withColumn(hash_column, F.coalesce(F.col(hash_column), F.lit("")))
    attributes = [c for c in columns if c in source.columns and c != key]

    closed = dimension.filter(~F.col("is_current"))
    current = dimension.filter("is_current")
    s = source.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_n_{c}") for c in attributes])
    met = current.withColumn("_c", F.lit(True)).join(s, F.col(key) == F.col("_k"), "full")
    changed = F.col("_k").isNotNull() & F.col("_c").isNotNull() & (F.col(f"_n_{hash_column}") != F.col(hash_column))
    same_day = F.col("effective_date") == today
    state = (
        F.when(F.col("_c").isNull(), "new").when(~F.coalesce(changed, F.lit(False)), "keep")
        .when(same_day, "overwrite").otherwise("replace")
    )
    # A replaced row gives two rows: the closed version and the new one.
    parts = F.when(F.col("_state") == "replace", F.array(F.lit("close"), F.lit("open"))).otherwise(
        F.array(F.col("_state")))
    split = met.withColumn("_state", state).withColumn("_part", F.explode(parts))
    fresh = F.col("_part").isin("new", "open")
    updated = fresh | (F.col("_part") == "overwrite")

    def value(c: str) -> Column:
        if c == key:
            return F.coalesce(key, "_k")
        if c == surrogate:
            return F.when(~fresh, F.col(c))
        if c == "effective_date":
            return F.when(fresh, today).otherwise(F.col(c))
        if c == "end_date":
            return F.when(F.col("_part") == "close", F.date_sub(today, 1)).when(~fresh, F.col(c))
        if c == "is_current":
            return F.col("_part") != "close"
        if c in attributes:
            return F.when(updated, F.col(f"_n_{c}")).otherwise(F.col(c))
        return F.when(~fresh, F.col(c))

    result = split.select(*[value(c).cast(dimension.schema[c].dataType).alias(c) for c in columns])
    fresh_rows = result.filter(F.col(surrogate).isNull()).drop(surrogate)
    if number is None:
        start = F.coalesce(dimension.agg(F.max(surrogate)).scalar(), F.lit(0))
        numbered = add_keys(fresh_rows, surrogate, key, start, slices)
    else:
        numbered = number(fresh_rows)
    return closed.unionByName(result.filter(F.col(surrogate).isNotNull())).unionByName(numbered.select(*columns))


def customer_history(dimension: DataFrame, as_of: dt.date) -> DataFrame:
    end = F.coalesce("end_date", D.day(as_of))
    return dimension.select(
        "customer_key", "customer_id", "full_name", "customer_segment", "loyalty_tier", "effective_date", "end_date",
        "is_current", F.datediff(end, "effective_date").alias("days_in_version"))


def point_in_time(rows: DataFrame, dimension: DataFrame, key: str, date_column: str,
                  columns: Sequence[str]) -> DataFrame:
    """The version valid on the row's date; rows without one keep NULLs."""
    versions = dimension.select(
        F.col(key).alias("_k"), F.col("effective_date").alias("_from"),
        F.coalesce("end_date", F.lit("9999-12-31").cast("date")).alias("_to"),
        *[F.col(c).alias(f"_d_{c}") for c in columns])
    valid = (F.col(key) == F.col("_k")) & F.col(date_column).between(F.col("_from"), F.col("_to"))
    return rows.join(versions, valid, "left").drop("_k", "_from", "_to").withColumnsRenamed(
        {f"_d_{c}": c for c in columns})


def point_in_time_merged(rows: DataFrame, dimension: DataFrame, key: str, date_column: str, columns: Sequence[str],
                         limit: int = HOT_ROWS, parts: int | None = None) -> DataFrame:
    """``point_in_time`` by a merge, for dimensions with many versions of a key.

    Rows and versions are stacked, dealt by key and read once in order of the day, so no row meets more than the version
    before it; a hot key is cut by day. Versions of a key must not overlap: of two that do, the later one counts.
    Versions that end before they begin hold on no day. Rows without key or day keep NULLs and are not shuffled.
    """
    known = F.col(key).isNotNull() & F.col(date_column).isNotNull()
    until = F.coalesce("end_date", F.lit("9999-12-31").cast("date"))
    version = F.struct(until.alias("_to"), *[F.col(c) for c in columns])
    versions = dimension.filter(F.col(key).isNotNull() & (F.col("effective_date") <= until)).select(
        F.col(key).alias("_k"), F.col("effective_date").alias("_day"), version.alias("_version"))
    given = rows.filter(known).withColumns({"_k": F.col(key), "_day": F.to_date(date_column)}).drop(key)
    both = given.unionByName(versions, allowMissingColumns=True)
    seen = last_version(both, ["_k"], "_day", "_version", "_to", "_last", limit, parts).filter(F.col("_version").isNull())
    valid = F.col("_last._to") >= F.col("_day")
    found = seen.select(
        *[F.col("_k").alias(c) if c == key else F.col(c) for c in rows.columns],
        *[F.when(valid, F.col(f"_last.{c}")).alias(c) for c in columns])
    nothing = [F.lit(None).cast(dimension.schema[c].dataType).alias(c) for c in columns]
    return found.union(rows.filter(~known).select("*", *nothing))
