"""Record hashes for change detection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Raw customer fields that count as a change, in hash order.
CUSTOMER_HASH_FIELDS = (
    "first_name", "last_name", "email", "phone", "customer_segment",
    "address_line1", "city", "state", "postal_code", "loyalty_points",
)
# The shorter list of the second hash.
CUSTOMER_SHORT_HASH_FIELDS = ("first_name", "last_name", "email", "city", "state")


def record_hash(fields: Sequence[Column | str]) -> Column:
    """MD5 over pipe-joined text; NULL counts as empty, so the hash itself is never NULL."""
    parts = [F.coalesce((F.col(f) if isinstance(f, str) else f).cast("string"), F.lit("")) for f in fields]
    return F.md5(F.concat_ws("|", *parts))


def row_digest(df: DataFrame, columns: Sequence[str]) -> Column:
    """Digest of whole rows that tells NULL from empty; VARIANT goes through its sorted JSON text."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    parts = [F.to_json(F.col(c)).alias(c) if isinstance(fields[c], T.VariantType) else F.col(c) for c in columns]
    return F.md5(F.to_json(F.struct(*parts), {"ignoreNullFields": "false"}))


def pseudonym(value: Column) -> Column:
    return F.sha2(value, 256)
