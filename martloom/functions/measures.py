"""Guarded ratios and rounded averages used by every mart."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(top: Column, bottom: Column, scale: int = 2, factor: int = 1) -> Column:
    """Rounded ``top / bottom * factor``; NULL where the bottom is zero.

    The types leave the quotient 14 or more decimals, so it is rounded only once.
    """
    divisor = bottom.cast("decimal(18,2)")
    quotient = top.cast("decimal(20,2)") / F.nullif(divisor, F.lit(0).cast("decimal(18,2)"))
    return F.round(quotient * factor if factor != 1 else quotient, scale)


def pct(top: Column, bottom: Column) -> Column:
    return ratio(top, bottom, 2, 100)


def change_pct(now: Column, before: Column) -> Column:
    return pct(now - before, before)


def average(value: Column) -> Column:
    """Mean of a decimal as sum over count: next to SUM of the same column it costs only a counter."""
    return F.sum(value) / F.nullif(F.count(value), F.lit(0))


def mean(value: Column, scale: int = 2) -> Column:
    return F.round(average(value), scale)


def count_if(condition: Column) -> Column:
    """Rows for which the condition is true; NULL does not count."""
    return F.count(F.when(condition, 1))


def discount_pct(gross: Column, net: Column) -> Column:
    zero = F.lit(0).cast("decimal(5,2)")
    return F.when(gross > 0, F.round((1 - net / F.nullif(gross, gross * 0)) * 100, 2)).otherwise(zero)
