"""What follows from an order's own columns is worked out behind the moves of the order summary, not moved."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from silverlode.plans import order_marts

ALL = order_marts.ORDER_SUMMARY_PARTS
FIRST = [
    "order_id", "order_date", "order_date_key", "total_amount", "customer_id", "restaurant_id", "current_status", "initial_status",
    "payment_method", "status_updated_at", "order_value_segment", "is_completed", "is_cancelled", "is_pending", "order_processing_time_mins",
]


@pytest.fixture
def tables(spark):
    at = lambda day, minute=0: datetime(2024, 1, day, 10, minute)
    orders = spark.createDataFrame(
        [("O1", at(1), "C1", 1, "COMPLETED", at(1), at(1, 9)), ("O2", at(2), "C1", 2, "PENDING", at(2), None), ("O3", at(2), None, 1, None, at(2), at(2))],
        "order_id string, order_date timestamp_ntz, customer_id string, restaurant_id int, order_status string, created_at timestamp_ntz, updated_at timestamp_ntz",
    ).withColumns({"total_amount": F.lit(5).cast("decimal(18,2)"), "payment_method": F.lit("UPI")})
    deliveries = spark.createDataFrame(
        [("D1", "O1", 1, at(1, 30), "DELIVERED", "40 mins"), ("D2", "O1", 2, at(1, 50), "FAILED", "x"), ("D9", "O9", 2, at(1), "DELIVERED", "1")],
        "delivery_id string, order_id string, delivery_agent_id int, delivery_date timestamp_ntz, delivery_status string, estimated_time string",
    )
    return {"fact_order": orders, "fact_delivery": deliveries}


def test_only_given_columns_of_an_order_are_moved(spark, tables):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = order_marts.order_summary(tables, ("delivery", "numbers"))._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moves = [n for n, line in enumerate(plan) if "Exchange hashpartitioning" in line]
    assert len([n for n in moves if re.search(r"_seg#", plan[n])]) >= 2
    assert [n for n in moves for line in plan[n:] if "order_value_segment" in line] == []


def test_rows_and_columns_stay_as_they_were(tables):
    made = order_marts.order_summary(tables, ("delivery", "numbers"))
    assert made.columns[:15] == FIRST and made.columns[15:] == [
        "delivery_id", "delivery_agent_id", "delivery_date", "delivery_status", "estimated_delivery_time_mins",
        "actual_delivery_time_mins", "is_on_time_delivery", "is_delivered", "customer_order_number", "restaurant_order_number",
    ]
    found = {(r.order_id, r.delivery_id): r for r in made.collect()}
    assert set(found) == {("O1", "D1"), ("O1", "D2"), ("O2", None), ("O3", None)}
    assert [(found[k].customer_order_number, found[k].restaurant_order_number) for k in sorted(found, key=str)] == [(1, 1), (2, 2), (3, 1), (1, 3)]
    one = found["O1", "D1"]
    assert (one.current_status, one.order_processing_time_mins, one.actual_delivery_time_mins, one.is_completed) == ("COMPLETED", 9, 30, 1)
    assert found["O2", None].order_processing_time_mins is None and found["O3", None].is_completed == 0
    assert order_marts.order_summary(tables, ("calendar",)).columns[:15] == FIRST
