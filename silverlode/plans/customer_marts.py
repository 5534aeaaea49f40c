"""Customer marts: cohorts, order summary, preferences, time patterns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from silverlode.functions import buckets
from silverlode.functions.scalar import as_date, boundary_diff, div0, mean_of, percent
from silverlode.operators.joins import current, lookup, top_per_group

Tables = Mapping[str, DataFrame]


def month_of(column: str):
    return F.trunc(F.to_date(column), "month")


def customer_cohort(t: Tables) -> DataFrame:
    """Retention by first-order month.

    Orders are reduced to (customer, month) first; the window over a customer
    then sees at most one row per calendar month.
    """
    monthly = (
        current(t["fact_order"])
        .groupBy("customer_id", month_of("order_date").alias("order_month"))
        .agg(F.count("order_id").alias("_orders"), F.sum("total_amount").alias("_revenue"))
        .withColumn("cohort_month", F.min("order_month").over(Window.partitionBy("customer_id")))
    )
    cohorts = monthly.groupBy("cohort_month", "order_month").agg(
        F.count(F.lit(1)).alias("active_customers"),
        F.sum("_orders").alias("total_orders"),
        F.sum("_revenue").alias("total_revenue"),
    )
    age = boundary_diff("month", "cohort_month", "order_month").alias("months_since_first_order")
    start = F.first("active_customers").over(Window.partitionBy("cohort_month").orderBy("order_month"))
    return cohorts.select(
        "cohort_month",
        "order_month",
        age,
        "active_customers",
        "total_orders",
        "total_revenue",
        F.round(percent(F.col("active_customers"), start), 2).alias("retention_rate"),
    )


def customer_order_summary(t: Tables, as_of) -> DataFrame:
    """One row per customer, in one aggregation.

    Months and payment methods of a customer are few, so their sets combine before
    the shuffle; distinct counts would expand every row instead.
    """
    status, method = F.col("order_status"), F.col("payment_method")
    metrics = current(t["fact_order"]).groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("total_amount").alias("lifetime_value"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        F.size(F.collect_set(month_of("order_date"))).cast("long").alias("active_months"),
        F.mode(method, True).alias("preferred_payment_method"),
        F.size(F.collect_set(method)).cast("long").alias("payment_methods_used"),
        F.count_if(status == "COMPLETED").alias("completed_orders"),
        F.count_if(status == "CANCELLED").alias("cancelled_orders"),
    )
    today = as_date(as_of)
    joined = current(t["dim_customer"]).join(metrics, "customer_id", "left").fillna(
        0, ["total_orders", "active_months", "payment_methods_used", "completed_orders", "cancelled_orders"]
    )
    orders_count, recency = F.col("total_orders"), F.col("days_since_last_order")
    return joined.select(
        "customer_id",
        "customer_name",
        "gender",
        "dob",
        boundary_diff("year", F.col("dob"), today).alias("customer_age"),
        "login_by_using",
        "preferences",
        "total_orders",
        "lifetime_value",
        mean_of("lifetime_value", "total_orders").alias("avg_order_value"),
        "first_order_date",
        "last_order_date",
        boundary_diff("day", "first_order_date", "last_order_date").alias("customer_tenure_days"),
        boundary_diff("day", F.col("last_order_date"), today).alias("days_since_last_order"),
        "active_months",
        div0(orders_count, F.nullif(F.col("active_months"), F.lit(0))).alias("orders_per_active_month"),
        "preferred_payment_method",
        "payment_methods_used",
        "completed_orders",
        "cancelled_orders",
        percent(F.col("cancelled_orders"), orders_count).alias("cancellation_rate"),
    ).select(
        "*",
        buckets.customer_segment(orders_count).alias("customer_segment"),
        buckets.customer_status(recency).alias("customer_status"),
    )


def customer_restaurant_preferences(t: Tables, k: int = 10) -> DataFrame:
    pairs = current(t["fact_order"]).groupBy("customer_id", "restaurant_id").agg(
        F.count("order_id").alias("orders_from_restaurant"),
        F.sum("total_amount").alias("total_spent"),
        F.max("order_date").alias("last_order_date"),
    )
    named = lookup(
        pairs, current(t["dim_restaurant"]), "restaurant_id", ["restaurant_name", "cuisine_type", "location_id"], "inner"
    )
    named = lookup(named, current(t["dim_customer"]), "customer_id", ["customer_name"], "inner")
    named = lookup(named, current(t["dim_location"]), "location_id", ["city", "state"]).drop("location_id")
    ranked = top_per_group(
        named,
        ["customer_id"],
        [F.col("orders_from_restaurant").desc(), F.col("restaurant_id")],
        k,
        "restaurant_preference_rank",
    )
    return ranked.withColumn("avg_spend_per_order", mean_of("total_spent", "orders_from_restaurant"))


def customer_time_patterns(t: Tables) -> DataFrame:
    day, hour = F.to_date("order_date"), F.hour("order_date")
    slots = current(t["fact_order"]).groupBy(
        "customer_id",
        F.dayname(day).alias("day_name"),
        buckets.iso_weekday(day).alias("day_of_week"),
        hour.alias("order_hour"),
    ).agg(F.count("order_id").alias("orders_by_day"), F.sum("total_amount").alias("revenue_by_day"))
    named = lookup(slots, current(t["dim_customer"]), "customer_id", ["customer_name"], "inner")
    return named.select(
        "*",
        buckets.time_of_day(F.col("order_hour")).alias("time_of_day"),
        buckets.day_type(F.col("day_of_week")).alias("day_type"),
    )
