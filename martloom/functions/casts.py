"""Casts that give NULL instead of an error, and NULL-token handling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that mean NULL in a delimited file, per format.
NULL_TOKENS_STANDARD = ("NULL", "null", "", "\\N", "NA", "N/A")
NULL_TOKENS_NO_HEADER = ("NULL", "null", "")
NULL_TOKENS_PIPE_TSV = ("NULL", "")


def null_if_token(value: Column, tokens: Sequence[str] = NULL_TOKENS_STANDARD) -> Column:
    return F.when(~value.isin(list(tokens)), value)


def try_number(value: Column, to: str = "bigint") -> Column:
    """Text to a whole number, rounding half away from zero (a plain int cast would truncate)."""
    return value.try_cast("decimal(38,0)").try_cast(to)


def try_decimal(value: Column, precision: int, scale: int) -> Column:
    """Text to DECIMAL(p,s); rounds, and gives NULL on overflow."""
    return value.try_cast(f"decimal({precision},{scale})")


def try_date(value: Column) -> Column:
    return value.try_cast("date")


def try_timestamp(value: Column) -> Column:
    """Text to a timestamp without zone; a trailing Z is accepted and dropped."""
    return F.regexp_replace(value, "Z$", "").try_cast("timestamp_ntz")


def try_boolean(value: Column) -> Column:
    word = F.lower(F.trim(value))
    return F.when(word == "on", True).when(word == "off", False).otherwise(word.try_cast("boolean"))
