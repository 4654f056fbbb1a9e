"""Semi-structured values: parsing, paths, flattening, building."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def safe_json(text: Column) -> Column:
    """Parsed document, or NULL if the text is not one valid JSON value.

    The parser stops after the first value; a closing element after the text
    makes anything that follows that value show.
    """
    framed = F.try_parse_json(F.concat(F.lit("["), text, F.lit(",0]")))
    alone = (F.try_variant_get(framed, "$[1]", "int") == 0) & F.try_variant_get(framed, "$[2]", "variant").isNull()
    return F.when(alone, F.try_variant_get(framed, "$[0]", "variant"))


def path(document: Column, where: str, to: str = "string") -> Column:
    """``a.b`` or ``$['odd-key']`` in a document; NULL if absent or of another type."""
    return F.try_variant_get(document, where if where.startswith("$") else f"$.{where}", to)


def has_key(document: Column, where: str) -> Column:
    return F.variant_get(document, where if where.startswith("$") else f"$.{where}", "variant").isNotNull()


def flatten(df: DataFrame, document: str, outer: bool = False) -> DataFrame:
    """One row per element of an object or array, as ``key`` (or position) and ``value``."""
    table_functions = df.sparkSession.tvf
    explode = table_functions.variant_explode_outer if outer else table_functions.variant_explode
    rows = df.lateralJoin(explode(F.col(document).outer()))
    return rows.withColumn("key", F.coalesce("key", F.col("pos").cast("string"))).drop("pos")


def build_object(fields: Mapping[str, Column]) -> Column:
    """JSON text of an object; a nested mapping is a nested object."""
    return F.to_json(_struct(fields))


def _struct(fields: Mapping[str, Column]) -> Column:
    return F.struct(*[
        (_struct(v) if isinstance(v, Mapping) else v).alias(k) for k, v in fields.items()
    ])
