"""Row filters. Role and user are arguments.

A mapping is first reduced to the grants of one user: distinct values, so the
filter joins a list no longer than the number of regions or segments.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions.masks import ACCOUNT_ADMIN, ADMIN, ENGINEER

ALL = "ALL"
FULL = "FULL"
REGION_BYPASS = (ADMIN, ENGINEER, ACCOUNT_ADMIN)
VIEW_BYPASS = (ACCOUNT_ADMIN, ADMIN)

# User, role, region of the view filter.
REGION_ACCESS = (
    ("REGIONAL_MANAGER_EAST", "RETAIL_ANALYST", "Northeast"),
    ("REGIONAL_MANAGER_WEST", "RETAIL_ANALYST", "West"),
    ("REGIONAL_MANAGER_SOUTH", "RETAIL_ANALYST", "South"),
    ("REGIONAL_MANAGER_MIDWEST", "RETAIL_ANALYST", "Midwest"),
    ("VP_SALES", "RETAIL_ADMIN", "ALL"),
)
# User, region, access level of the row policy.
REGION_MAPPING = (
    ("DATA_ANALYST_01", "Northeast", "REGION_ONLY"),
    ("DATA_ANALYST_02", "West", "REGION_ONLY"),
    ("DATA_ENGINEER_01", None, "FULL"),
    ("RETAIL_ADMIN_USER", None, "FULL"),
    ("BI_VIEWER", "ALL", "REGION_ONLY"),
)
# User, segment.
SEGMENT_ACCESS = (("DATA_ANALYST_01", "STANDARD"), ("DATA_ANALYST_01", "PREMIUM"), ("DATA_ANALYST_02", "VIP"))


def region_access(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(REGION_ACCESS), "user_name string, role_name string, region string")


def region_mapping(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(REGION_MAPPING), "user_name string, region string, access_level string")


def segment_access(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(SEGMENT_ACCESS), "user_name string, segment string")


def _matches(rows: DataFrame, grants: DataFrame, column: str, everything: Column) -> DataFrame:
    """Rows whose value is granted, or all rows if the grants hold a blanket one."""
    values = grants.filter(~everything & F.col("_value").isNotNull()).select("_value").distinct()
    blanket = F.coalesce(grants.agg(F.max(everything)).scalar(), F.lit(False))
    joined = rows.join(values, F.col(column) == F.col("_value"), "left")
    return joined.filter(F.col("_value").isNotNull() | blanket).drop("_value")


def by_region_policy(rows: DataFrame, mapping: DataFrame, column: str, role: str, user: str) -> DataFrame:
    """Privileged roles see all; others their region, or all with FULL level or region ALL."""
    if role in REGION_BYPASS:
        return rows
    grants = mapping.filter(F.col("user_name") == user).select(F.col("region").alias("_value"), "access_level")
    everything = F.coalesce((F.col("access_level") == FULL) | (F.col("_value") == ALL), F.lit(False))
    return _matches(rows, grants, column, everything)


def by_segment_policy(rows: DataFrame, mapping: DataFrame, column: str, role: str, user: str,
                      bypass: Sequence[str] = REGION_BYPASS) -> DataFrame:
    if role in bypass:
        return rows
    granted = mapping.filter(F.col("user_name") == user).select(F.col("segment").alias(column)).distinct()
    return rows.join(granted, column, "left_semi")


def by_view_access(rows: DataFrame, access: DataFrame, column: str, role: str, user: str) -> DataFrame:
    """Admins see all; a grant matches by user or by role, and region ALL opens everything."""
    if role in VIEW_BYPASS:
        return rows
    mine = (F.col("user_name") == user) | (F.col("role_name") == role)
    grants = access.filter(mine).select(F.col("region").alias("_value"))
    return _matches(rows, grants, column, F.coalesce(F.col("_value") == ALL, F.lit(False)))
