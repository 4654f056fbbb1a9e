"""Comparison of two versions of a keyed table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from martloom.operators.keys import union_counts


def counts(versions: Mapping[str, DataFrame]) -> DataFrame:
    return union_counts(dict(versions), "version", "cnt")


def deleted(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the old version whose key is gone."""
    return old.join(new.select(*keys), list(keys), "left_anti")


def added(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    return new.join(old.select(*keys), list(keys), "left_anti")


def restore_deleted(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The new version with the missing rows put back from the old one."""
    return new.unionByName(deleted(old, new, keys).select(*new.columns))
