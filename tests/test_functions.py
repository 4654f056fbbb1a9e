import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martloom.functions import bands, casts, masks, measures, tables, variants
from martloom.functions import dates as D
from martloom.functions.hashing import CUSTOMER_HASH_FIELDS, record_hash


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def text(value):
    return F.lit(value).cast("string")


@pytest.mark.parametrize("column, expected", [
    (lambda: casts.try_number(text("12.7")), 13),
    (lambda: casts.try_number(text("-2.5")), -3),
    (lambda: casts.try_number(text("x")), None),
    (lambda: casts.try_decimal(text("1.239"), 10, 2), Decimal("1.24")),
    (lambda: casts.try_decimal(text("123456789.1"), 5, 2), None),
    (lambda: casts.try_date(text("2024-02-30")), None),
    (lambda: casts.try_timestamp(text("2024-01-15T14:30:00.000Z")), dt.datetime(2024, 1, 15, 14, 30)),
    (lambda: casts.try_boolean(text("Yes")), True),
    (lambda: casts.try_boolean(text("off")), False),
    (lambda: casts.try_boolean(text("maybe")), None),
    (lambda: casts.null_if_token(text("N/A")), None),
    (lambda: casts.null_if_token(text("\\N")), None),
    (lambda: casts.null_if_token(text("ok")), "ok"),
    (lambda: casts.null_if_token(text(None)), None),
    (lambda: D.years_crossed(D.day("1990-12-31"), D.day("2024-01-01")), 34),
    (lambda: D.completed_years(D.day("1990-12-31"), D.day("2024-01-01")), 33),
    (lambda: D.completed_years(D.day("2000-02-29"), D.day("2024-02-29")), 24),
    (lambda: D.months_crossed(D.day("2024-01-31"), D.day("2024-02-01")), 1),
    (lambda: D.weekday_from_sunday(D.day("2024-01-07")), 0),
    (lambda: D.date_key(D.day("2024-01-05")), 20240105),
    (lambda: D.week_start(D.day("2024-01-07")), dt.date(2024, 1, 1)),
    (lambda: bands.loyalty_tier(F.lit(40000)), "PLATINUM"),
    (lambda: bands.loyalty_tier(F.lit(None).cast("int")), "BRONZE"),
    (lambda: bands.age_group(F.lit(None).cast("date"), D.day("2024-01-01")), "65+"),
    (lambda: bands.age_group(D.day("2020-01-01"), D.day("2024-01-01")), "18-24"),
    (lambda: bands.region_of(F.lit("LA")), "Other"),
    (lambda: bands.region_of(F.lit("LA"), bands.STORE_REGIONS), "South"),
    (lambda: bands.region_of(F.lit(None).cast("string")), "Other"),
    (lambda: bands.value_tier(F.lit(5000)), "MEDIUM_VALUE"),
    (lambda: masks.shorten_email(F.lit("john.smith@email.com")), "jo***@email.com"),
    (lambda: masks.shorten_email(F.lit("a@b.com")), "***@***"),
    (lambda: masks.mask_email(F.lit("john@x.com"), "RETAIL_ANALYST"), "jo****@x.com"),
    (lambda: masks.mask_email(F.lit("john@x.com"), "RETAIL_VIEWER"), "****@****.***"),
    (lambda: masks.mask_phone(F.lit("555-0101"), "RETAIL_VIEWER"), "***-****"),
    (lambda: masks.mask_name(F.lit("Ann"), "RETAIL_ANALYST"), "A**"),
    (lambda: masks.mask_name(F.lit(""), "RETAIL_ANALYST"), ""),
    (lambda: masks.mask_card(F.lit("4000123412341234"), "RETAIL_ENGINEER"), "************1234"),
    (lambda: masks.mask_email_by_segment(F.lit("jo@x.com"), F.lit("VIP"), "RETAIL_ENGINEER"), "****@****.***"),
    (lambda: F.levenshtein(F.lit("hello"), F.lit("hallo")), 1),
    (lambda: measures.pct(F.lit(1), F.lit(8)), Decimal("12.50")),
    (lambda: measures.pct(F.lit(1), F.lit(0)), None),
    (lambda: measures.discount_pct(F.lit(Decimal("0.00")), F.lit(Decimal("0.00"))), Decimal("0.00")),
    (lambda: variants.safe_json(F.lit('{"a": 1} x')).isNull(), True),
    (lambda: variants.safe_json(F.lit("1,0")).isNull(), True),
    (lambda: F.to_json(variants.safe_json(F.lit('{"b": 2, "a": [1]}'))), '{"a":[1],"b":2}'),
])
def test_scalar(spark, column, expected):
    found = one(spark, column())
    assert found == expected and type(found) is type(expected)


def test_record_hash_of_a_customer(spark):
    row = {f: "" for f in CUSTOMER_HASH_FIELDS} | {"first_name": "Ann", "city": None}
    values = [F.lit(row[f]).cast("string") for f in CUSTOMER_HASH_FIELDS]
    import hashlib

    expected = hashlib.md5(("Ann" + "|" * (len(CUSTOMER_HASH_FIELDS) - 1)).encode()).hexdigest()
    assert one(spark, record_hash(values)) == expected


def test_registered_sql_functions(spark):
    tables.register_sql_functions(spark)
    row = spark.sql("SELECT udf_value_tier(5000), udf_age(DATE '1990-12-31', DATE '2024-01-01'), "
                    "udf_discount_pct(100, 90), udf_mask_email('john.smith@email.com'), "
                    "udf_levenshtein('hello', 'hallo'), udf_safe_json('{') IS NULL").first()
    assert list(row) == ["MEDIUM_VALUE", 33, Decimal("10.00"), "jo***@email.com", 1, True]
    assert spark.sql("SELECT * FROM udtf_date_range(DATE '2024-01-01', DATE '2024-01-10')").count() == 10
    parts = spark.sql("SELECT * FROM udtf_split('a.b.c', '.')").collect()
    assert [tuple(r) for r in parts] == [(1, "a"), (2, "b"), (3, "c")]


def test_default_calendar(spark):
    from martloom.operators import calendar

    days = calendar.dim_date(spark)
    last = days.orderBy(F.desc("full_date")).first()
    assert days.count() == 2192 and last["full_date"] == dt.date(2025, 12, 31)
    named = {r["full_date"]: r["holiday_name"] for r in days.filter("is_holiday AND year_number = 2024").collect()}
    assert named == {
        dt.date(2024, 1, 1): "New Year's Day", dt.date(2024, 5, 27): "Memorial Day",
        dt.date(2024, 7, 4): "Independence Day", dt.date(2024, 9, 2): "Labor Day",
        dt.date(2024, 11, 28): "Thanksgiving", dt.date(2024, 12, 25): "Christmas Day"}


def test_flatten_array_and_object(spark):
    docs = spark.createDataFrame([(1, '{"a": 1, "b": [2, 3]}'), (2, "[5, 6]"), (3, "{}")], "id int, t string")
    docs = docs.select("id", F.parse_json("t").alias("doc"))
    rows = variants.flatten(docs, "doc").select("id", "key", F.to_json("value").alias("v")).collect()
    assert sorted(map(tuple, rows)) == [(1, "a", "1"), (1, "b", "[2,3]"), (2, "0", "5"), (2, "1", "6")]
    assert variants.flatten(docs, "doc", outer=True).filter("id = 3").count() == 1
