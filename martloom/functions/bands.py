"""Banding of values. An unknown (NULL) value falls into the last band."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from martloom.functions.dates import years_crossed

# Lower bounds and labels.
LOYALTY_TIERS = ((40000, "PLATINUM"), (20000, "GOLD"), (10000, "SILVER"))
LOYALTY_DEFAULT = "BRONZE"
VALUE_TIERS = ((10000, "HIGH_VALUE"), (5000, "MEDIUM_VALUE"), (1000, "LOW_VALUE"))
VALUE_DEFAULT = "NEW_CUSTOMER"
# Upper bounds (exclusive) of the year difference.
AGE_GROUPS = ((25, "18-24"), (35, "25-34"), (45, "35-44"), (55, "45-54"), (65, "55-64"))
AGE_DEFAULT = "65+"
# States of each region; the store list is longer than the customer list.
CUSTOMER_REGIONS = {
    "Northeast": ("NY", "NJ", "PA", "MA", "CT"),
    "West": ("CA", "OR", "WA", "NV", "AZ"),
    "South": ("TX", "FL", "GA", "NC", "VA"),
    "Midwest": ("IL", "OH", "MI", "IN", "WI"),
}
STORE_REGIONS = {
    "Northeast": ("NY", "NJ", "PA", "MA", "CT", "RI", "VT", "NH", "ME"),
    "West": ("CA", "OR", "WA", "NV", "AZ", "CO", "UT", "HI", "AK"),
    "South": ("TX", "FL", "GA", "NC", "VA", "SC", "AL", "TN", "LA", "MS"),
    "Midwest": ("IL", "OH", "MI", "IN", "WI", "MN", "IA", "MO", "KS", "NE"),
}
REGION_DEFAULT = "Other"


def _chain(tests: Sequence[tuple[Column, str]], default: str) -> Column:
    out = None
    for condition, label in tests:
        out = F.when(condition, label) if out is None else out.when(condition, label)
    return out.otherwise(default)


def at_least(value: Column, bands: Sequence[tuple[float, str]], default: str) -> Column:
    return _chain([(value >= low, label) for low, label in bands], default)


def below(value: Column, bands: Sequence[tuple[float, str]], default: str) -> Column:
    return _chain([(value < high, label) for high, label in bands], default)


def loyalty_tier(points: Column) -> Column:
    return at_least(points, LOYALTY_TIERS, LOYALTY_DEFAULT)


def value_tier(lifetime_value: Column) -> Column:
    return at_least(lifetime_value, VALUE_TIERS, VALUE_DEFAULT)


def age_group(born: Column, as_of: Column) -> Column:
    """Uses the plain year difference, so it can run a year ahead of the real age."""
    return below(years_crossed(born, as_of), AGE_GROUPS, AGE_DEFAULT)


def region_of(state: Column, regions: Mapping[str, Sequence[str]] = CUSTOMER_REGIONS) -> Column:
    return _chain([(state.isin(list(states)), name) for name, states in regions.items()], REGION_DEFAULT)
