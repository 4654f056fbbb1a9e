"""Named queries with their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.plans.star import Star

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Column types both engines agree on: money as double, VARIANT as JSON text."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            out.append(F.col(f.name).cast("double").alias(f.name))
        elif isinstance(f.dataType, T.VariantType):
            out.append(F.to_json(F.col(f.name)).alias(f.name))
        elif isinstance(f.dataType, T.NullType):
            out.append(F.col(f.name).cast("string").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(out)


def query(name: str, oracle: str | None = None):
    def register(build: Callable[[Star], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plain(build(Star(spark, folder)))

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return build

    return register
