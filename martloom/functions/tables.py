"""Table functions, access functions, and their registration for SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ALL_REGIONS = "ALL"


def date_range(spark: SparkSession, first: str, last: str) -> DataFrame:
    """Every date from ``first`` to ``last``."""
    days = F.datediff(F.lit(last).cast("date"), F.lit(first).cast("date"))
    span = spark.range(1).select(F.sequence(F.lit(0), days).alias("n"))
    return span.select(F.explode("n").alias("n")).select(
        F.date_add(F.lit(first).cast("date"), F.col("n")).alias("date_value"))


def split_parts(df: DataFrame, text: Column, delimiter: str) -> DataFrame:
    """Numbered parts of a text; the delimiter is taken literally."""
    parts = F.split(text, "\\Q" + delimiter + "\\E")
    return number_parts(df.withColumn("_parts", parts), "_parts").drop("_parts")


def number_parts(df: DataFrame, array: str) -> DataFrame:
    """One row per array element, numbered from 1."""
    return df.select("*", F.posexplode(array).alias("_pos", "part_value")).withColumn(
        "part_number", F.col("_pos") + 1).drop("_pos")


def user_region(mapping: DataFrame, user: str) -> Column:
    """Region mapped to the user. An unmapped user, or one mapped to NULL, gets ``ALL`` and so sees everything."""
    found = mapping.filter(F.col("user_name") == user).agg(F.max("region").alias("region"))
    return F.coalesce(found.scalar(), F.lit(ALL_REGIONS))


def can_access_region(mapping: DataFrame, user: str, region: Column) -> Column:
    granted = user_region(mapping, user)
    return (granted == ALL_REGIONS) | (granted == region)


# SQL bodies of the registered functions.
SQL_FUNCTIONS = {
    "udf_value_tier": "(ltv DECIMAL(12,2)) RETURNS STRING RETURN CASE WHEN ltv >= 10000 THEN 'HIGH_VALUE' "
                      "WHEN ltv >= 5000 THEN 'MEDIUM_VALUE' WHEN ltv >= 1000 THEN 'LOW_VALUE' ELSE 'NEW_CUSTOMER' END",
    "udf_age": "(dob DATE, as_of DATE) RETURNS INT RETURN year(as_of) - year(dob) - "
               "CAST(month(as_of) * 100 + day(as_of) < month(dob) * 100 + day(dob) AS INT)",
    "udf_discount_pct": "(gross DECIMAL(12,2), net DECIMAL(12,2)) RETURNS DECIMAL(5,2) RETURN "
                        "CASE WHEN gross > 0 THEN round((1 - net / nullif(gross, 0)) * 100, 2) ELSE 0 END",
    "udf_mask_email": "(email STRING) RETURNS STRING RETURN CASE WHEN email IS NULL THEN NULL "
                      "WHEN locate('@', email) > 2 THEN concat(left(email, 2), '***', "
                      "substring(email, locate('@', email))) ELSE '***@***' END",
    "udf_safe_json": "(t STRING) RETURNS VARIANT RETURN try_parse_json(t)",
    "udf_levenshtein": "(a STRING, b STRING) RETURNS INT RETURN levenshtein(a, b)",
    "udtf_date_range": "(first DATE, last DATE) RETURNS TABLE (date_value DATE) "
                       "RETURN SELECT explode(sequence(first, last))",
    "udtf_split": "(t STRING, d STRING) RETURNS TABLE (part_number INT, part_value STRING) RETURN "
                  "SELECT pos + 1, col FROM (SELECT posexplode(split(t, concat('\\\\Q', d, '\\\\E'))))",
}


def register_sql_functions(spark: SparkSession) -> None:
    for name, body in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
