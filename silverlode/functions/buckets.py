"""Label columns.  Every function is total: a NULL input takes the default label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Steps = Sequence[tuple[float, str]]

# Thresholds and labels that results depend on.
TIME_OF_DAY = [((6, 11), "MORNING"), ((12, 16), "AFTERNOON"), ((17, 21), "EVENING")]
MEAL_TIME = [((7, 10), "BREAKFAST"), ((11, 14), "LUNCH"), ((16, 18), "SNACK"), ((19, 22), "DINNER")]
PEAK = [((12, 14), "LUNCH_PEAK"), ((19, 21), "DINNER_PEAK")]
SEASON = [((3, 5), "SPRING"), ((6, 8), "SUMMER"), ((9, 11), "FALL")]
MONTH_PERIOD = [(10, "EARLY_MONTH"), (20, "MID_MONTH")]
ORDER_VALUE = [(200, "LOW_VALUE"), (500, "MEDIUM_VALUE"), (1000, "HIGH_VALUE")]
PAYMENT = {
    "CARD": ["CARD", "CREDIT_CARD", "DEBIT_CARD"],
    "UPI": ["UPI", "GPAY", "PHONEPE", "PAYTM"],
    "CASH": ["CASH"],
    "WALLET": ["WALLET"],
    "NET_BANKING": ["NET_BANKING"],
}
CUSTOMER_SEGMENT = [(20, "VIP"), (10, "LOYAL"), (5, "REGULAR"), (2, "REPEAT")]
CUSTOMER_STATUS = [(30, "ACTIVE"), (90, "AT_RISK")]
JOURNEY_STAGE = [(1, "FIRST_ORDER"), (2, "SECOND_ORDER"), (5, "EARLY_ORDERS"), (10, "REGULAR_CUSTOMER")]
ORDER_FREQUENCY = [(1, "SAME_DAY"), (7, "WITHIN_WEEK"), (30, "WITHIN_MONTH"), (90, "WITHIN_QUARTER")]
DELIVERY_SPEED = [(30, "FAST"), (45, "NORMAL"), (60, "SLOW")]
STATUS_VELOCITY = [(5, "HIGH_VELOCITY"), (3, "NORMAL_VELOCITY")]
WEEKEND = (6, 7)


def _in_ranges(value: Column, ranges: Sequence, default: str) -> Column:
    label = F.lit(default)
    for (low, high), name in reversed(ranges):
        label = F.when(value.between(low, high), name).otherwise(label)
    return label


def _at_most(value: Column, steps: Steps, default: str) -> Column:
    label = F.lit(default)
    for bound, name in reversed(steps):
        label = F.when(value <= bound, name).otherwise(label)
    return label


def _below(value: Column, steps: Steps, default: str) -> Column:
    label = F.lit(default)
    for bound, name in reversed(steps):
        label = F.when(value < bound, name).otherwise(label)
    return label


def _at_least(value: Column, steps: Steps, default: str) -> Column:
    label = F.lit(default)
    for bound, name in reversed(steps):
        label = F.when(value >= bound, name).otherwise(label)
    return label


def iso_weekday(day: Column) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return (F.weekday(day) + 1).cast("int")


def time_of_day(hour: Column) -> Column:
    return _in_ranges(hour, TIME_OF_DAY, "NIGHT")


def meal_time(hour: Column) -> Column:
    return _in_ranges(hour, MEAL_TIME, "LATE_NIGHT")


def peak_indicator(hour: Column) -> Column:
    return _in_ranges(hour, PEAK, "OFF_PEAK")


def day_type(weekday: Column) -> Column:
    return F.when(weekday.isin(*WEEKEND), "WEEKEND").otherwise("WEEKDAY")


def day_category(weekday: Column) -> Column:
    return (
        F.when(weekday.isin(*WEEKEND), "WEEKEND")
        .when(weekday == 1, "MONDAY")
        .when(weekday == 5, "FRIDAY")
        .otherwise("MID_WEEK")
    )


def season(month: Column) -> Column:
    """A missing month is FALL, the default label; December to February are WINTER."""
    return F.when(month.isin(12, 1, 2), "WINTER").otherwise(_in_ranges(month, SEASON, "FALL"))


def month_period(day_of_month: Column) -> Column:
    return _at_most(day_of_month, MONTH_PERIOD, "END_MONTH")


def order_value_segment(amount: Column) -> Column:
    return _below(amount, ORDER_VALUE, "PREMIUM")


def payment_category(method: Column) -> Column:
    label = F.lit("OTHER")
    for name, methods in PAYMENT.items():
        label = F.when(method.isin(*methods), name).otherwise(label)
    return label


def customer_segment(orders: Column) -> Column:
    return _at_least(orders, CUSTOMER_SEGMENT, "NEW")


def customer_status(recency_days: Column) -> Column:
    return _at_most(recency_days, CUSTOMER_STATUS, "CHURNED")


def journey_stage(order_number: Column) -> Column:
    return _at_most(order_number, JOURNEY_STAGE, "LOYAL_CUSTOMER")


def order_frequency_type(gap_days: Column) -> Column:
    return _at_most(gap_days, ORDER_FREQUENCY, "REACTIVATED")


def spending_trend(amount: Column, previous: Column) -> Column:
    """The missing previous amount is tested first, so that a first order is named as such."""
    return (
        F.when(previous.isNull(), "FIRST_ORDER")
        .when(amount > previous, "INCREASED")
        .when(amount < previous, "DECREASED")
        .otherwise("SAME")
    )


def churn_risk(next_order: Column, days_to_as_of: Column) -> Column:
    last = (
        F.when(days_to_as_of > 90, "HIGH_CHURN_RISK")
        .when(days_to_as_of > 30, "MEDIUM_CHURN_RISK")
        .otherwise("LOW_CHURN_RISK")
    )
    return F.when(next_order.isNotNull(), "RETURNED").otherwise(last)


def timeliness(actual: Column, estimate: Column) -> Column:
    return (
        F.when(actual <= estimate, "ON_TIME")
        .when(actual <= estimate + 10, "SLIGHTLY_DELAYED")
        .otherwise("DELAYED")
    )


def timeliness_detailed(actual: Column, estimate: Column) -> Column:
    return (
        F.when(actual <= estimate, "ON_TIME")
        .when(actual <= estimate + 10, "SLIGHTLY_DELAYED")
        .when(actual <= estimate + 20, "DELAYED")
        .otherwise("SEVERELY_DELAYED")
    )


def delivery_speed(minutes: Column) -> Column:
    return _at_most(minutes, DELIVERY_SPEED, "VERY_SLOW")


def distance_category(from_area: Column, to_area: Column, from_city: Column, to_city: Column) -> Column:
    return (
        F.when(from_area == to_area, "SAME_LOCALITY")
        .when(from_city == to_city, "SAME_CITY")
        .otherwise("DIFFERENT_CITY")
    )


def flag(condition: Column) -> Column:
    """1 when the condition holds, 0 when it fails or is unknown."""
    return F.when(condition, 1).otherwise(0)


def agent_tier(success_pct: Column, deliveries: Column) -> Column:
    return (
        F.when((success_pct >= 95) & (deliveries >= 100), "EXCELLENT")
        .when(success_pct >= 90, "GOOD")
        .when(success_pct >= 80, "AVERAGE")
        .otherwise("NEEDS_IMPROVEMENT")
    )


def restaurant_tier(orders: Column, average_value: Column) -> Column:
    return (
        F.when((orders >= 500) & (average_value >= 500), "PLATINUM")
        .when((orders >= 200) & (average_value >= 300), "GOLD")
        .when(orders >= 50, "SILVER")
        .otherwise("BRONZE")
    )


def daily_tier(orders: Column, revenue: Column) -> Column:
    return (
        F.when((orders >= 50) & (revenue >= 25000), "TOP_PERFORMER")
        .when((orders >= 20) & (revenue >= 10000), "HIGH_PERFORMER")
        .when(orders >= 10, "AVERAGE_PERFORMER")
        .otherwise("LOW_PERFORMER")
    )


def status_velocity(transitions: Column) -> Column:
    return _at_least(transitions, STATUS_VELOCITY, "LOW_VELOCITY")


def cancellation_stage(status: Column, last_sequence: Column) -> Column:
    stage = (
        F.when(last_sequence == 1, "CANCELLED_IMMEDIATELY")
        .when(last_sequence <= 3, "CANCELLED_EARLY")
        .otherwise("CANCELLED_LATE")
    )
    return F.when(status == "CANCELLED", stage).otherwise("NOT_CANCELLED")


def order_outcome(status: Column, minutes: Column) -> Column:
    return (
        F.when((status == "COMPLETED") & (minutes <= 60), "FAST_COMPLETION")
        .when(status == "COMPLETED", "NORMAL_COMPLETION")
        .when(status == "CANCELLED", "FAILED")
        .otherwise("IN_PROGRESS")
    )


def rank_of(column: Column, labels: Sequence[str]) -> Column:
    """Position of a label in its business order, for sorting; unknown labels come first."""
    position = F.lit(None).cast("int")
    for number, label in enumerate(labels, start=1):
        position = F.when(column == label, number).otherwise(position)
    return position
