"""Names of given columns kept apart from the names that operators use inside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def given(name: str) -> Column:
    """The column of that very name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def marks(docs: DataFrame) -> list[Column]:
    """Two hashes of the whole row, ``_a`` and ``_b``, which tell rows apart that share an id."""
    row = [given(c) for c in docs.columns]
    return [F.xxhash64(*row).alias("_a"), F.hash(*row).alias("_b")]


def numbered(docs: DataFrame) -> DataFrame:
    """The rows with their ``marks``, and under the names ``_c0``, ``_c1`` and so on, by place."""
    return docs.select(*[given(c).alias(f"_c{i}") for i, c in enumerate(docs.columns)], *marks(docs))


def one_of_alike(docs: DataFrame) -> DataFrame:
    """``numbered`` with one row of those alike in every column. Each task lets one of them through before the shuffle."""
    turn = F.row_number().over(Window.partitionBy("_a", "_b").orderBy("_b"))
    return numbered(docs).withColumn("_turn", turn).filter(F.col("_turn") == 1).drop("_turn")


def number_of(docs: DataFrame, name: str) -> str:
    """The name that a column has in ``numbered``; as in Spark, case does not count."""
    return f"_c{[c.lower() for c in docs.columns].index(name.lower())}"


def back(docs: DataFrame, *but: str) -> list[Column]:
    """The columns of ``numbered`` under their given names, without those named in ``but``, in lower case."""
    return [F.col(f"_c{i}").alias(c) for i, c in enumerate(docs.columns) if c.lower() not in but]
