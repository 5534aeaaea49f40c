"""Dashboard and sample reports: thin aggregates over the marts.

Functions take mart frames, so that a caller may pass a mart computed once or a
stored one.  ``between`` limits a frame to a date range, which Catalyst pushes
below the mart's joins.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.functions.buckets import rank_of
from silverlode.functions.scalar import as_date, as_timestamp, boundary_diff, div0, mean
from silverlode.operators.joins import current

# Business order of labels.
TIMES = ["MORNING", "AFTERNOON", "EVENING", "NIGHT"]
MEALS = ["BREAKFAST", "LUNCH", "SNACK", "DINNER", "LATE_NIGHT"]
SEGMENTS = ["VIP", "LOYAL", "REGULAR", "REPEAT", "NEW"]
VALUES = ["PREMIUM", "HIGH_VALUE", "MEDIUM_VALUE", "LOW_VALUE"]
AGENT_TIERS = ["EXCELLENT", "GOOD", "AVERAGE", "NEEDS_IMPROVEMENT"]


def between(mart: DataFrame, start, end, column: str = "order_date") -> DataFrame:
    return mart.where(F.col(column).between(as_timestamp(start), as_timestamp(end)))


def between_days(mart: DataFrame, start, end, column: str = "order_date_key") -> DataFrame:
    return mart.where(F.col(column).between(as_date(start), as_date(end)))


def _once(rows: DataFrame, *labels: Column | str) -> DataFrame:
    """Rows reduced to their order: sums of amounts, and labels that are the same for the whole order.

    The rows come from a join on the order, so this needs no shuffle of its own,
    and it turns distinct orders into a plain count.
    """
    return rows.groupBy("order_id", "customer_id", *labels).agg(
        F.sum("total_amount").alias("_sum"), F.count("total_amount").alias("_n")
    )


def _revenue() -> Column:
    return F.sum("_sum")


def _average() -> Column:
    return F.sum("_sum").cast("double") / F.sum("_n")


def _orders() -> Column:
    return F.count("order_id")


def executive_kpis(summary: DataFrame) -> DataFrame:
    return _once(summary).agg(
        _orders().alias("total_orders"), _revenue().alias("total_revenue"), _average().alias("avg_order_value"),
        F.count_distinct("customer_id").alias("unique_customers"),
    )


def daily_orders(summary: DataFrame) -> DataFrame:
    days = _once(summary, F.to_date("order_date").alias("order_day")).groupBy("order_day")
    return days.agg(_orders().alias("orders"), _revenue().alias("revenue")).orderBy("order_day")


def orders_by(mart: DataFrame, column: str, order: list[str] | None = None) -> DataFrame:
    """Distinct orders per label, in business order if one is given."""
    counted = mart.groupBy(column).agg(F.count_distinct("order_id").alias("orders"))
    return counted.orderBy(rank_of(F.col(column), order) if order else F.col(column))


def top_restaurants(performance: DataFrame, k: int = 5) -> DataFrame:
    rows = performance.select("restaurant_name", "total_orders", "total_revenue", "avg_order_value")
    return rows.orderBy(F.col("total_orders").desc(), "restaurant_name").limit(k)


def top_cuisines(cuisines: DataFrame, by: str, k: int) -> DataFrame:
    rows = cuisines.select("cuisine_type", "city", "total_orders", "total_revenue")
    return rows.orderBy(F.col(by).desc_nulls_last(), "cuisine_type", "city").limit(k)


def customer_kpis(customers: DataFrame) -> DataFrame:
    return customers.agg(
        F.count("customer_id").alias("total_customers"), mean("lifetime_value").alias("avg_ltv"),
        mean("total_orders").alias("avg_orders_per_customer"),
        F.count_if(F.col("customer_status") == "ACTIVE").alias("active_customers"),
    )


def customer_segments(customers: DataFrame) -> DataFrame:
    grouped = customers.groupBy("customer_segment").agg(
        F.count("customer_id").alias("customers"), mean("lifetime_value").alias("avg_ltv")
    )
    return grouped.orderBy(rank_of(F.col("customer_segment"), SEGMENTS))


def customer_statuses(customers: DataFrame) -> DataFrame:
    return customers.groupBy("customer_status").agg(F.count("customer_id").alias("customers"))


def cohort_retention(cohorts: DataFrame, as_of, months: int = 6) -> DataFrame:
    since = F.add_months(as_date(as_of), -months)
    grouped = cohorts.where(F.col("cohort_month") >= since).groupBy("cohort_month", "months_since_first_order")
    return grouped.agg(F.avg("retention_rate").alias("retention_rate")).orderBy("cohort_month", "months_since_first_order")


def cohort_matrix(cohorts: DataFrame, as_of, last_month: int, months: int = 6) -> DataFrame:
    """Retention as a matrix, a column for each month up to ``last_month`` since the first order.

    The pivot values are given, so no extra pass finds them; months beyond the last column stay in the map ``later``.
    """
    rows = cohort_retention(cohorts, as_of, months)
    month, rate = F.col("months_since_first_order"), F.col("retention_rate")
    cells = [F.max(F.when(month == m, rate)).alias(f"month_{m}") for m in range(last_month + 1)]
    beyond = F.sort_array(F.collect_list(F.when(month > last_month, F.struct(month, rate))))
    return rows.groupBy("cohort_month").agg(*cells, F.map_from_entries(beyond).alias("later"))


def restaurant_kpis(performance: DataFrame) -> DataFrame:
    return performance.agg(
        F.count("restaurant_id").alias("total_restaurants"), mean("total_orders").alias("avg_orders"),
        F.avg("avg_order_value").alias("avg_order_value"), F.avg("cancellation_rate").alias("avg_cancel_rate"),
    )


def restaurant_tiers(performance: DataFrame) -> DataFrame:
    return performance.groupBy("restaurant_tier").agg(
        F.count("restaurant_id").alias("restaurants"), mean("total_revenue").alias("avg_revenue")
    )


def restaurant_cities(performance: DataFrame) -> DataFrame:
    return performance.select("city").distinct().orderBy("city")


def restaurant_table(performance: DataFrame, city: str | None = None, k: int = 20) -> DataFrame:
    rows = performance if city is None else performance.where(F.col("city") == city)
    rows = rows.select(
        "restaurant_name", "cuisine_type", "city", "total_orders", "total_revenue", "avg_order_value", "cancellation_rate",
        "restaurant_tier",
    )
    return rows.orderBy(F.col("total_revenue").desc_nulls_last(), "restaurant_name").limit(k)


def delivery_kpis(times: DataFrame) -> DataFrame:
    on_time = F.count_if(F.col("delivery_timeliness") == "ON_TIME").cast("double") / F.count(F.lit(1)) * 100
    return times.agg(
        F.count("delivery_id").alias("total_deliveries"), on_time.alias("on_time_pct"),
        mean("actual_delivery_time_mins").alias("avg_delivery_time"), mean("time_variance_mins").alias("avg_variance"),
    )


def delivery_timeliness(times: DataFrame) -> DataFrame:
    return times.groupBy("delivery_timeliness").agg(F.count("delivery_id").alias("deliveries"))


def agent_tiers(agents: DataFrame) -> DataFrame:
    grouped = agents.groupBy("performance_tier").agg(
        F.count("delivery_agent_id").alias("agents"), F.avg("success_rate").alias("avg_success_rate")
    )
    return grouped.orderBy(rank_of(F.col("performance_tier"), AGENT_TIERS))


def top_agents(agents: DataFrame, k: int = 15) -> DataFrame:
    rows = agents.select(
        "delivery_agent_name", "city", "total_deliveries", "successful_deliveries", "success_rate",
        "avg_estimated_time_mins", "performance_tier",
    )
    best = rows.orderBy(F.col("successful_deliveries").desc(), "delivery_agent_name").limit(k)
    return best.fillna(0, ["total_deliveries", "successful_deliveries", "success_rate", "avg_estimated_time_mins"])


def order_kpis(summary: DataFrame) -> DataFrame:
    minutes = "order_processing_time_mins"
    return summary.groupBy("order_id").agg(
        F.sum("is_completed").alias("_completed"), F.sum("is_cancelled").alias("_cancelled"),
        F.sum(minutes).alias("_sum"), F.count(minutes).alias("_n"),
    ).agg(
        _orders().alias("total_orders"), F.sum("_completed").alias("completed_orders"),
        F.sum("_cancelled").alias("cancelled_orders"), _average().alias("avg_process_time"),
    )


def value_segments(summary: DataFrame) -> DataFrame:
    segment = "order_value_segment"
    grouped = _once(summary, segment).groupBy(segment).agg(_orders().alias("orders"), _revenue().alias("revenue"))
    return grouped.orderBy(rank_of(F.col(segment), VALUES))


def day_types(summary: DataFrame) -> DataFrame:
    return _once(summary, "day_type").groupBy("day_type").agg(_orders().alias("orders"), _average().alias("avg_value"))


def revenue_kpis(summary: DataFrame) -> DataFrame:
    return _once(summary).agg(
        _revenue().alias("total_revenue"), _average().alias("avg_order_value"),
        div0(_revenue(), F.count_distinct("customer_id")).alias("revenue_per_customer"), _orders().alias("total_orders"),
    )


def revenue_trend(summary: DataFrame) -> DataFrame:
    days = _once(summary, F.to_date("order_date").alias("order_day")).groupBy("order_day")
    return days.agg(
        _revenue().alias("daily_revenue"), _orders().alias("daily_orders"), _average().alias("avg_order_value")
    ).orderBy("order_day")


def revenue_by(mart: DataFrame, column: str) -> DataFrame:
    grouped = _once(mart, column).groupBy(column).agg(_revenue().alias("revenue"), _orders().alias("orders"))
    return grouped.orderBy(F.col("revenue").desc())


def top_cities(summary: DataFrame, k: int = 10) -> DataFrame:
    grouped = _once(summary, "city").groupBy("city").agg(
        _revenue().alias("total_revenue"), _orders().alias("total_orders"), _average().alias("avg_order_value"),
        F.count_distinct("customer_id").alias("unique_customers"),
    )
    return grouped.orderBy(F.col("total_revenue").desc(), "city").limit(k)


# ---- sample queries ----------------------------------------------------------------------


def daily_metrics(fact_order: DataFrame, status: str) -> DataFrame:
    rows = fact_order.where(F.col("order_status") == status)
    return rows.groupBy(F.to_date("order_date").alias("order_day")).agg(
        F.count("order_id").alias("total_orders"), F.sum("total_amount").alias("revenue"),
        F.count_distinct("customer_id").alias("unique_customers"),
    ).orderBy(F.col("order_day").desc())


def top_restaurants_by_items(t: Mapping[str, DataFrame], k: int = 10) -> DataFrame:
    """Item revenue per restaurant; the order average weighs each order by its items.

    Items are reduced to their order before the join, so facts meet one to one.
    """
    items = t["fact_order_item"].groupBy("order_id").agg(F.count(F.lit(1)).alias("_items"), F.sum("subtotal").alias("_sub"))
    restaurants = current(t["dim_restaurant"]).select("restaurant_id", "restaurant_name")
    orders = current(t["fact_order"]).select("order_id", "restaurant_id", "total_amount")
    return (
        orders.join(items, "order_id")
        .groupBy("restaurant_id")
        .agg(
            F.count("order_id").alias("order_count"), F.sum("_items").alias("_items"),
            F.sum(F.col("total_amount") * F.col("_items")).alias("_weighted"), F.sum("_sub").alias("_sub"),
        )
        .join(restaurants, "restaurant_id")
        .groupBy("restaurant_name")
        .agg(
            F.sum("order_count").alias("order_count"),
            (F.sum("_weighted").cast("double") / F.sum("_items")).alias("avg_order_value"),
            F.sum("_sub").alias("total_revenue"),
        )
        .orderBy(F.col("total_revenue").desc(), "restaurant_name")
        .limit(k)
    )


def stuck_deliveries(fact_delivery: DataFrame, as_of, minutes: int = 60) -> DataFrame:
    waiting = current(fact_delivery).where(F.col("delivery_status").isin("ASSIGNED", "PICKED_UP", "IN_TRANSIT"))
    stuck = boundary_diff("minute", F.col("updated_at"), as_timestamp(as_of))
    return waiting.select(
        "delivery_id", "order_id", F.col("delivery_status").alias("current_status"),
        F.col("updated_at").alias("status_updated_at"), stuck.alias("stuck_minutes"),
    ).where(F.col("stuck_minutes") > minutes)
