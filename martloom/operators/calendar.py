"""Generated calendar dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions import dates as D

# First day and length of the default calendar.
DEFAULT_START = dt.date(2020, 1, 1)
DEFAULT_DAYS = 2192

# Holiday name, month, 3-letter weekday (None = any) and day-of-month range.
HOLIDAYS = (
    ("New Year's Day", 1, None, 1, 1),
    ("Independence Day", 7, None, 4, 4),
    ("Christmas Day", 12, None, 25, 25),
    ("Thanksgiving", 11, "Thu", 22, 28),
    ("Memorial Day", 5, "Mon", 25, 31),
    ("Labor Day", 9, "Mon", 1, 7),
)
# Fixed value: the fiscal year starts in July.
FISCAL_START_MONTH = 7


def generate_dates(spark: SparkSession, start: dt.date = DEFAULT_START, days: int = DEFAULT_DAYS) -> DataFrame:
    """Consecutive dates; one row per day, so the result is bounded by ``days``."""
    return spark.range(0, days, 1, 1).select(F.date_add(D.day(start), F.col("id").cast("int")).alias("date_value"))


def holiday_name(d) -> F.Column:
    out = F.lit(None).cast("string")
    for name, month, weekday, first, last in reversed(HOLIDAYS):
        hit = (F.month(d) == month) & F.dayofmonth(d).between(first, last)
        if weekday:
            hit = hit & (F.dayname(d) == weekday)
        out = F.when(hit, name).otherwise(out)
    return out


def dim_date(spark: SparkSession, start: dt.date = DEFAULT_START, days: int = DEFAULT_DAYS,
             as_of: dt.date | None = None) -> DataFrame:
    """Calendar, July fiscal year, holidays; flags relative to ``as_of`` (false if it is not given)."""
    d = F.col("date_value")
    weekend = D.weekday_from_sunday(d).isin(0, 6)
    fiscal_quarter = F.floor(F.pmod(F.month(d) - FISCAL_START_MONTH, F.lit(12)) / 3).cast("int") + 1
    base = generate_dates(spark, start, days).select(
        D.date_key(d).alias("date_key"),
        d.alias("full_date"),
        D.weekday_from_sunday(d).alias("day_of_week"),
        F.dayname(d).alias("day_name"),
        F.left(F.dayname(d), F.lit(3)).alias("day_short_name"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofyear(d).alias("day_of_year"),
        F.weekofyear(d).alias("week_of_year"),
        D.week_start(d).alias("week_start_date"),
        F.date_add(D.week_start(d), 6).alias("week_end_date"),
        F.month(d).alias("month_number"),
        F.monthname(d).alias("month_name"),
        F.left(F.monthname(d), F.lit(3)).alias("month_short_name"),
        F.trunc(d, "month").alias("month_start_date"),
        F.last_day(d).alias("month_end_date"),
        F.quarter(d).alias("quarter_number"),
        F.concat(F.lit("Q"), F.quarter(d)).alias("quarter_name"),
        F.year(d).alias("year_number"),
        (F.year(d) + (F.month(d) >= FISCAL_START_MONTH).cast("int")).alias("fiscal_year"),
        fiscal_quarter.alias("fiscal_quarter"),
        F.concat(F.lit("FQ"), fiscal_quarter).alias("fiscal_quarter_name"),
        weekend.alias("is_weekend"),
        holiday_name(d).alias("holiday_name"),
    )
    holiday = F.col("holiday_name").isNotNull()
    return (
        base.withColumn("is_holiday", holiday)
        .withColumn("is_business_day", ~F.col("is_weekend") & ~holiday)
        .withColumns(relative_flags(as_of))
    )


def relative_flags(as_of: dt.date | None) -> dict[str, F.Column]:
    names = ("day", "week", "month", "quarter", "year")
    if as_of is None:
        return {f"is_current_{n}": F.lit(False) for n in names}
    ref, d = D.day(as_of), F.col("full_date")
    same_year = F.year(d) == F.year(ref)
    return {
        "is_current_day": d == ref,
        "is_current_week": (F.weekofyear(d) == F.weekofyear(ref)) & same_year,
        "is_current_month": (F.month(d) == F.month(ref)) & same_year,
        "is_current_quarter": (F.quarter(d) == F.quarter(ref)) & same_year,
        "is_current_year": same_year,
    }


def current_month_calendar(calendar: DataFrame) -> DataFrame:
    return calendar.filter("is_current_month").select(
        "date_key", "full_date", "day_name", "is_weekend", "is_holiday", "is_business_day"
    )


def business_days_by_month(calendar: DataFrame) -> DataFrame:
    return calendar.groupBy("year_number", "month_number", "month_name").agg(
        F.count("*").alias("total_days"),
        F.count_if("is_business_day").alias("business_days"),
        F.count_if("is_weekend").alias("weekend_days"),
        F.count_if("is_holiday").alias("holidays"),
    )


def date_coverage(calendar: DataFrame) -> DataFrame:
    return calendar.agg(
        F.min("full_date").alias("earliest_date"),
        F.max("full_date").alias("latest_date"),
        F.count("*").alias("total_days"),
        F.countDistinct("year_number").alias("years_covered"),
        F.count_if("is_holiday").alias("total_holidays"),
    )
