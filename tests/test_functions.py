from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from silverlode.functions import buckets as b
from silverlode.functions.privacy import mask_columns
from silverlode.functions.scalar import boundary_diff, digits_to_int, div0, most_common, row_hash


def values(spark, inputs, kind, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_div0(spark):
    df = spark.createDataFrame([(1, 0), (1, None), (None, 2), (3, 2)], "a int, b int")
    assert [r[0] for r in df.select(div0("a", "b")).collect()] == [0.0, None, None, 1.5]


@pytest.mark.parametrize(
    "unit, start, end, expected",
    [
        ("year", "1999-12-31 23:59:59", "2000-01-01 00:00:00", 1),
        ("year", "2000-01-01 00:00:00", "2000-12-31 00:00:00", 0),
        ("month", "2001-01-31 00:00:00", "2001-02-01 00:00:00", 1),
        ("month", "2001-02-01 00:00:00", "2000-11-30 00:00:00", -3),
        ("day", "2001-01-01 23:59:59", "2001-01-02 00:00:00", 1),
        ("hour", "2001-01-01 10:59:59", "2001-01-01 11:00:00", 1),
        ("minute", "2001-01-01 10:00:59", "2001-01-01 10:01:00", 1),
        ("minute", "1969-12-31 23:59:30", "1970-01-01 00:00:30", 1),
        ("second", "2001-01-01 00:00:00", "2001-01-01 00:00:59", 59),
    ],
)
def test_boundary_diff(spark, unit, start, end, expected):
    df = spark.createDataFrame([(datetime.fromisoformat(start), datetime.fromisoformat(end))], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(boundary_diff(unit, "a", "b")).first()[0] == expected


def test_boundary_diff_of_null_and_bad_unit(spark):
    df = spark.createDataFrame([(None, date(2001, 1, 1))], "a date, b date")
    assert df.select(boundary_diff("day", "a", "b")).first()[0] is None
    with pytest.raises(ValueError):
        boundary_diff("fortnight", "a", "b")


def test_digits_to_int(spark):
    assert values(spark, ["45 mins", "TBD", None, "1h 30"], "string", digits_to_int) == [45, None, None, 130]


def test_row_hash_treats_null_as_empty_and_keeps_separators_apart(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, "x"), ("", "x"), ("a\\", "|b"), ("a", "\\|b")], "p string, q string")
    hashes = [r[0] for r in df.select(row_hash(["p", "q"])).collect()]
    assert hashes[0] != hashes[1]
    assert hashes[2] == hashes[3]
    assert hashes[4] != hashes[5]


def test_most_common_breaks_ties_by_value_and_ignores_null(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, None), (2, None), (2, "z"), (3, "c"), (3, "c"), (3, "a")], "k int, v string")
    assert {tuple(r) for r in most_common(df, ["k"], "v", "m").collect()} == {(1, "a"), (2, "z"), (3, "c")}


@pytest.mark.parametrize(
    "fn, kind, cases",
    [
        (b.time_of_day, "int", {5: "NIGHT", 6: "MORNING", 11: "MORNING", 12: "AFTERNOON", 16: "AFTERNOON", 17: "EVENING", 21: "EVENING", 22: "NIGHT", None: "NIGHT"}),
        (b.meal_time, "int", {6: "LATE_NIGHT", 7: "BREAKFAST", 10: "BREAKFAST", 11: "LUNCH", 15: "LATE_NIGHT", 16: "SNACK", 19: "DINNER", 23: "LATE_NIGHT"}),
        (b.peak_indicator, "int", {11: "OFF_PEAK", 12: "LUNCH_PEAK", 14: "LUNCH_PEAK", 15: "OFF_PEAK", 19: "DINNER_PEAK", 22: "OFF_PEAK", None: "OFF_PEAK"}),
        (b.day_type, "int", {5: "WEEKDAY", 6: "WEEKEND", 7: "WEEKEND", None: "WEEKDAY"}),
        (b.day_category, "int", {1: "MONDAY", 2: "MID_WEEK", 5: "FRIDAY", 6: "WEEKEND", None: "MID_WEEK"}),
        (b.season, "int", {12: "WINTER", 2: "WINTER", 3: "SPRING", 6: "SUMMER", 9: "FALL", None: "FALL"}),
        (b.month_period, "int", {10: "EARLY_MONTH", 11: "MID_MONTH", 20: "MID_MONTH", 21: "END_MONTH", None: "END_MONTH"}),
        (b.order_value_segment, "double", {199.99: "LOW_VALUE", 200.0: "MEDIUM_VALUE", 500.0: "HIGH_VALUE", 1000.0: "PREMIUM", None: "PREMIUM"}),
        (b.payment_category, "string", {"DEBIT_CARD": "CARD", "GPAY": "UPI", "CASH": "CASH", "BARTER": "OTHER", None: "OTHER"}),
        (b.customer_segment, "int", {20: "VIP", 19: "LOYAL", 9: "REGULAR", 2: "REPEAT", 1: "NEW", None: "NEW"}),
        (b.customer_status, "int", {30: "ACTIVE", 31: "AT_RISK", 90: "AT_RISK", 91: "CHURNED", None: "CHURNED"}),
        (b.journey_stage, "int", {1: "FIRST_ORDER", 2: "SECOND_ORDER", 5: "EARLY_ORDERS", 10: "REGULAR_CUSTOMER", 11: "LOYAL_CUSTOMER"}),
        (b.order_frequency_type, "int", {1: "SAME_DAY", 7: "WITHIN_WEEK", 30: "WITHIN_MONTH", 90: "WITHIN_QUARTER", 91: "REACTIVATED", None: "REACTIVATED"}),
        (b.delivery_speed, "int", {30: "FAST", 45: "NORMAL", 60: "SLOW", 61: "VERY_SLOW", None: "VERY_SLOW"}),
        (b.status_velocity, "int", {5: "HIGH_VELOCITY", 3: "NORMAL_VELOCITY", 2: "LOW_VELOCITY", None: "LOW_VELOCITY"}),
    ],
)
def test_labels(spark, fn, kind, cases):
    assert values(spark, list(cases), kind, fn) == list(cases.values())


def test_two_argument_labels(spark):
    df = spark.createDataFrame([(10, 10), (20, 10), (30, 10), (31, 10), (5, None)], "a int, e int")
    a, e = F.col("a"), F.col("e")
    assert [tuple(r) for r in df.select(b.timeliness(a, e), b.timeliness_detailed(a, e)).collect()] == [
        ("ON_TIME", "ON_TIME"), ("SLIGHTLY_DELAYED", "SLIGHTLY_DELAYED"), ("DELAYED", "DELAYED"), ("DELAYED", "SEVERELY_DELAYED"), ("DELAYED", "SEVERELY_DELAYED"),
    ]
    assert [r[0] for r in df.select(b.spending_trend(a, e)).collect()] == ["SAME", "INCREASED", "INCREASED", "INCREASED", "FIRST_ORDER"]
    tiers = spark.createDataFrame([(95.0, 100), (95.0, 99), (80.0, 1), (79.9, 1), (None, None)], "p double, n int")
    assert [r[0] for r in tiers.select(b.agent_tier(F.col("p"), F.col("n"))).collect()] == ["EXCELLENT", "GOOD", "AVERAGE", "NEEDS_IMPROVEMENT", "NEEDS_IMPROVEMENT"]


def test_iso_weekday(spark):
    days = [date(2024, 1, 1), date(2024, 1, 6), date(2024, 1, 7)]
    assert values(spark, days, "date", b.iso_weekday) == [1, 6, 7]


def test_masks_are_constant_even_for_null(spark):
    df = spark.createDataFrame([("a", None, "x"), ("b", "m@x", "y")], "name string, email string, other string")
    masked = mask_columns(df, {"name": "PII", "email": "EMAIL"})
    assert [tuple(r) for r in masked.collect()] == [("** PII **", "** EMAIL **", "x"), ("** PII **", "** EMAIL **", "y")]
    with pytest.raises(ValueError):
        mask_columns(df, {"name": "SECRET"})
