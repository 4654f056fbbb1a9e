"""Reshaping, ordering and text checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Strict pattern and loose LIKE pattern of an e-mail address.
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
EMAIL_LIKE = "%_@_%.__%"
# Months in pivot order.
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def invalid_email(email: Column) -> Column:
    """True for a set address that does not match; NULL for no address."""
    return ~email.rlike(EMAIL_PATTERN)


def invalid_email_loose(email: Column) -> Column:
    return ~email.like(EMAIL_LIKE)


def pivot_sum(df: DataFrame, index: Sequence[str], name: str, value: str, names: Sequence[str] = MONTHS) -> DataFrame:
    """One column per listed name; listing them saves the pass that would collect them."""
    return df.groupBy(*index).pivot(name, list(names)).agg(F.sum(value))


def unpivot(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str = "attribute_name",
            value: str = "attribute_value") -> DataFrame:
    """Columns to rows; NULL values give no row."""
    return df.unpivot(list(ids), list(columns), name, value).filter(F.col(value).isNotNull())


def by_rank(column: str, worst_first: Sequence[str]) -> Column:
    """Sort key that puts listed values first, in that order."""
    out = F.lit(len(worst_first))
    for i, label in reversed(list(enumerate(worst_first))):
        out = F.when(F.col(column) == label, i).otherwise(out)
    return out


def top(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)
