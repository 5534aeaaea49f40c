"""Order marts: cohorts, journey, fulfilment, payments, daily performance, status, summary, time."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverlode.functions import buckets
from silverlode.functions.scalar import as_date, boundary_diff, digits_to_int, div0, mean, mean_of, percent
from silverlode.operators.dims import calendar_columns
from silverlode.operators.joins import current, lookup, with_totals
from silverlode.operators.sequence import (
    lag,
    lead,
    moving_average,
    row_number,
    running,
    total,
    with_features,
)
from silverlode.plans.customer_marts import month_of

Tables = Mapping[str, DataFrame]


def _restaurant(t: Tables, df: DataFrame, columns: Collection[str], places: Collection[str] = ()) -> DataFrame:
    """Restaurant attributes and, through its location, place attributes."""
    dimension = current(t["dim_restaurant"])
    if places:
        dimension = lookup(dimension, current(t["dim_location"]), "location_id", list(places))
    return lookup(df, dimension, "restaurant_id", [*columns, *places])


def _day(column: str = "order_date") -> Column:
    return F.to_date(column)


def order_cohort(t: Tables) -> DataFrame:
    """Cohorts with retention, value and loyalty.

    Orders are reduced to (customer, month, restaurant) in the first shuffle;
    days since the first order are carried as a sum of day numbers.
    """
    reduced = current(t["fact_order"]).groupBy("customer_id", month_of("order_date").alias("order_month"), "restaurant_id").agg(
        F.count("order_id").alias("_n"),
        F.sum("total_amount").alias("_sum"),
        F.sum(F.unix_date(_day())).alias("_days"),
        F.min("order_date").alias("_first"),
        F.min("total_amount").alias("_amount"),
    )
    firsts = reduced.groupBy("customer_id").agg(
        F.to_date(F.min("_first")).alias("first_day"),
        F.min("restaurant_id").alias("first_restaurant"),
        F.min("_amount").alias("first_amount"),
    )
    per_customer = (
        reduced.join(firsts, "customer_id")
        .groupBy("customer_id", F.trunc("first_day", "month").alias("cohort_month"), "order_month")
        .agg(
            F.sum("_n").alias("_n"),
            F.sum("_sum").alias("_sum"),
            F.sum(F.col("_days") - F.col("_n") * F.unix_date("first_day")).alias("_days"),
            F.sum(F.when(F.col("restaurant_id") == F.col("first_restaurant"), F.col("_n")).otherwise(0)).alias("_loyal"),
            F.sum(F.col("_n") * F.col("first_amount")).alias("_first_sum"),
        )
    )
    cells = per_customer.groupBy("cohort_month", "order_month").agg(
        F.count(F.lit(1)).alias("active_customers"),
        F.sum("_n").alias("total_orders"),
        F.sum("_sum").alias("total_revenue"),
        F.sum("_days").alias("_days"),
        F.sum("_loyal").alias("orders_from_first_restaurant"),
        F.sum("_first_sum").alias("_first_sum"),
    )
    by_age = Window.partitionBy("cohort_month").orderBy("order_month")
    cells = cells.withColumn("cohort_size", F.first("active_customers").over(by_age)).withColumn(
        "cumulative_cohort_revenue", F.sum("total_revenue").over(by_age)
    )
    orders = F.col("total_orders")
    return cells.select(
        "cohort_month",
        "order_month",
        boundary_diff("month", "cohort_month", "order_month").alias("months_since_first_order"),
        "cohort_size",
        "active_customers",
        "total_orders",
        "total_revenue",
        percent("active_customers", "cohort_size").alias("retention_rate"),
        mean_of("total_revenue", orders).alias("avg_order_value"),
        div0(orders, "active_customers").alias("orders_per_customer"),
        div0("total_revenue", "active_customers").alias("revenue_per_customer"),
        mean_of("_first_sum", orders).alias("avg_first_order_amount"),
        "orders_from_first_restaurant",
        percent("orders_from_first_restaurant", orders).alias("first_restaurant_loyalty_rate"),
        "cumulative_cohort_revenue",
        mean_of("_days", orders).alias("avg_days_from_first_order"),
    )


def customer_journey(t: Tables, as_of) -> DataFrame:
    orders = current(t["fact_order"]).select(
        "order_id", "customer_id", "order_date", "total_amount", "order_status", "restaurant_id", "payment_method"
    )
    sequence = with_features(
        orders,
        ["customer_id"],
        ["order_date", "order_id"],
        [
            row_number("order_sequence_number"),
            lag("_prev_date", "order_date"),
            lag("_prev_restaurant", "restaurant_id"),
            lag("previous_order_amount", "total_amount"),
            lead("_next_date", "order_date"),
            running("restaurants_tried_to_date", "count", "restaurant_id"),
            running("cumulative_spend", "sum", "total_amount"),
            running("avg_order_value_to_date", "avg", "total_amount"),
            running("payment_methods_used_to_date", "count", "payment_method"),
        ],
    )
    named = lookup(sequence, current(t["dim_customer"]), "customer_id", ["customer_name", "gender", "dob"])
    named = _restaurant(t, named, ["restaurant_name", "cuisine_type"], ["city", "state"])
    gap = boundary_diff("day", "_prev_date", "order_date")
    hour = F.hour("order_date")
    return named.select(
        "order_id",
        "customer_id",
        "customer_name",
        "gender",
        boundary_diff("year", "dob", "order_date").alias("customer_age_at_order"),
        "order_date",
        "total_amount",
        F.col("order_status").alias("current_status"),
        "restaurant_id",
        "restaurant_name",
        "cuisine_type",
        "city",
        "state",
        "order_sequence_number",
        buckets.journey_stage(F.col("order_sequence_number")).alias("customer_journey_stage"),
        gap.alias("days_since_last_order"),
        buckets.order_frequency_type(gap).alias("order_frequency_type"),
        buckets.flag(F.col("restaurant_id") == F.col("_prev_restaurant")).alias("is_repeat_restaurant"),
        "restaurants_tried_to_date",
        "previous_order_amount",
        (F.col("total_amount") - F.coalesce("previous_order_amount", F.lit(0))).alias("order_amount_change"),
        buckets.spending_trend(F.col("total_amount"), F.col("previous_order_amount")).alias("spending_trend"),
        "cumulative_spend",
        "avg_order_value_to_date",
        boundary_diff("day", "order_date", "_next_date").alias("days_until_next_order"),
        buckets.churn_risk(F.col("_next_date"), boundary_diff("day", F.col("order_date"), as_date(as_of))).alias(
            "churn_risk_level"
        ),
        "payment_method",
        "payment_methods_used_to_date",
        hour.alias("order_hour"),
        buckets.time_of_day(hour).alias("time_of_day"),
    )


def order_fulfillment(t: Tables) -> DataFrame:
    """One row per order and delivery, with place, time and agent load."""
    orders = current(t["fact_order"]).select(
        "order_id", "order_date", "customer_id", "restaurant_id", "total_amount", "order_status",
        boundary_diff("minute", "created_at", "updated_at").alias("order_processing_time_mins"),
    )
    deliveries = current(t["fact_delivery"]).select(
        "order_id", "delivery_id", "delivery_agent_id", "delivery_date", "delivery_status", "customer_address_id",
        digits_to_int("estimated_time").alias("estimated_delivery_time_mins"),
        boundary_diff("minute", "created_at", "updated_at").alias("delivery_processing_time_mins"),
    )
    # Current versions hold each delivery once, so the count per agent and day is a distinct count.
    # Deliveries of unknown orders are not among the rows, and not in the agent's load.
    # Large dimensions are joined where rows are few and narrow: customers to orders, loads and addresses to deliveries.
    deliveries = deliveries.withColumn("_day", F.to_date("delivery_date"))
    known = deliveries.join(orders.select("order_id"), "order_id", "left_semi")
    load = F.count("delivery_id").alias("agent_deliveries_same_day")
    deliveries = with_totals(deliveries, known, ["delivery_agent_id", "_day"], load).drop("_day")
    addresses = current(t["dim_customer_address"])
    kind = "addresstype" if "addresstype" in addresses.columns else "address_type"  # as loaded, or as the mart names it
    addresses = addresses.select(
        "customer_address_id",
        F.col("locality").alias("delivery_locality"),
        F.col("city").alias("delivery_city"),
        F.col("zipcode").alias("delivery_zipcode"),
        F.col(kind).alias("address_type"),
    )
    deliveries = deliveries.join(addresses, "customer_address_id", "left").drop("customer_address_id")
    named = lookup(orders, current(t["dim_customer"]), "customer_id", ["customer_name"])
    named = named.join(deliveries, "order_id", "left").fillna(0, ["agent_deliveries_same_day"])
    restaurants = lookup(current(t["dim_restaurant"]), current(t["dim_location"]), "location_id", ["city"]).select(
        "restaurant_id",
        "restaurant_name",
        "cuisine_type",
        F.col("locality").alias("restaurant_locality"),
        F.col("city").alias("restaurant_city"),
    )
    named = named.join(restaurants, "restaurant_id", "left")
    named = lookup(
        named, current(t["dim_delivery_agent"]), "delivery_agent_id", ["delivery_agent_name", "vehicle_type", "rating"]
    )
    actual, estimate = F.col("actual_delivery_time_mins"), F.col("estimated_delivery_time_mins")
    hour, day = F.hour("order_date"), _day()
    status, delivery = F.col("order_status"), F.col("delivery_status")
    timed = named.withColumn("actual_delivery_time_mins", boundary_diff("minute", "order_date", "delivery_date"))
    return timed.select(
        "order_id", "order_date", "customer_id", "customer_name", "restaurant_id", "restaurant_name", "cuisine_type",
        "total_amount", "order_status", "delivery_id", "delivery_agent_id", "delivery_agent_name", "vehicle_type",
        F.col("rating").alias("agent_rating"),
        "delivery_date", "delivery_status", "delivery_locality", "delivery_city", "delivery_zipcode", "address_type",
        "restaurant_locality", "restaurant_city",
        estimate, actual, "order_processing_time_mins", "delivery_processing_time_mins",
        (actual - estimate).alias("delivery_time_variance_mins"),
        buckets.timeliness_detailed(actual, estimate).alias("delivery_timeliness"),
        buckets.delivery_speed(actual).alias("delivery_speed"),
        buckets.distance_category(
            F.col("delivery_locality"), F.col("restaurant_locality"), F.col("delivery_city"), F.col("restaurant_city")
        ).alias("delivery_distance_category"),
        buckets.flag((status == "COMPLETED") & (delivery == "DELIVERED")).alias("is_successfully_fulfilled"),
        buckets.flag((status == "CANCELLED") | (delivery == "FAILED")).alias("is_failed_fulfillment"),
        hour.alias("order_hour"),
        buckets.time_of_day(hour).alias("time_of_day"),
        F.dayname(day).alias("day_name"),
        buckets.day_type(buckets.iso_weekday(day)).alias("day_type"),
        "agent_deliveries_same_day",
    )


def order_payment(t: Tables) -> DataFrame:
    orders = current(t["fact_order"]).select(
        "order_id", "order_date", "customer_id", "restaurant_id", "total_amount", "payment_method", "order_status"
    )
    order = ["order_date", "order_id"]
    used = with_features(orders, ["customer_id"], order, [running("payment_methods_used_to_date", "count", "payment_method")])
    used = with_features(
        used,
        ["customer_id", "payment_method"],
        order,
        [
            row_number("payment_method_use_count"),
            total("customer_avg_order_value_by_payment", "avg", "total_amount"),
        ],
        facts=orders,
    )
    # Restaurants may be hot, so their figures come from an aggregate that is joined back.
    by_restaurant = (
        orders.groupBy("restaurant_id", "payment_method")
        .agg(mean("total_amount").alias("restaurant_avg_order_value_by_payment"))
        .withColumn("restaurant_payment_methods_accepted", F.count("payment_method").over(Window.partitionBy("restaurant_id")))
        .withColumnsRenamed({"restaurant_id": "_restaurant", "payment_method": "_method"})
    )
    used = used.join(
        by_restaurant,
        F.col("restaurant_id").eqNullSafe(F.col("_restaurant")) & F.col("payment_method").eqNullSafe(F.col("_method")),
        "left",
    )
    named = lookup(used, current(t["dim_customer"]), "customer_id", ["customer_name"])
    named = _restaurant(t, named, ["restaurant_name"], ["city", "state", "city_tier"])
    status, method, day, hour = F.col("order_status"), F.col("payment_method"), _day(), F.hour("order_date")
    weekday = buckets.iso_weekday(day)
    return named.select(
        "order_id", "order_date", day.alias("order_date_key"), "customer_id", "customer_name", "restaurant_id",
        "restaurant_name", "total_amount", "payment_method", status.alias("current_status"), "city", "state", "city_tier",
        F.year(day).alias("year"), F.month(day).alias("month"), weekday.alias("day_of_week"),
        buckets.day_type(weekday).alias("day_type"),
        hour.alias("order_hour"),
        buckets.payment_category(method).alias("payment_category"),
        buckets.order_value_segment(F.col("total_amount")).alias("order_value_segment"),
        "payment_methods_used_to_date", "payment_method_use_count",
        buckets.flag(F.col("payment_method_use_count") == 1).alias("is_first_use_of_payment_method"),
        "restaurant_payment_methods_accepted",
        buckets.flag(status == "COMPLETED").alias("payment_success"),
        buckets.flag((status == "CANCELLED") & method.isin("CARD", "UPI", "NET_BANKING")).alias("potential_payment_failure"),
        "customer_avg_order_value_by_payment", "restaurant_avg_order_value_by_payment",
    )


def restaurant_daily(t: Tables) -> DataFrame:
    """Daily metrics per restaurant with moving, week-over-week and month-to-date values.

    After the aggregation a restaurant has at most one row per day, and a day
    and city at most one row per restaurant, so the windows stay small.
    """
    daily = current(t["fact_order"]).groupBy("restaurant_id", _day().alias("order_day")).agg(
        F.count("order_id").alias("daily_orders"),
        F.sum("total_amount").alias("daily_revenue"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.count_if(F.col("order_status") == "COMPLETED").alias("completed_orders"),
        F.count_if(F.col("order_status") == "CANCELLED").alias("cancelled_orders"),
        mean(boundary_diff("minute", "created_at", "updated_at")).alias("avg_processing_time"),
    )
    month = F.trunc("order_day", "month")
    daily = daily.withColumn("order_week", F.trunc("order_day", "week")).withColumn("order_month", month)
    daily = with_features(
        daily,
        ["restaurant_id"],
        ["order_day"],
        [
            moving_average("ma7_orders", "daily_orders", 7),
            moving_average("ma7_revenue", "daily_revenue", 7),
            lag("orders_same_day_last_week", "daily_orders", 7),
        ],
        bounded=True,
    )
    daily = with_features(
        daily,
        ["restaurant_id", "order_month"],
        ["order_day"],
        [running("mtd_orders", "sum", "daily_orders"), running("mtd_revenue", "sum", "daily_revenue")],
        bounded=True,
    )
    named = _restaurant(
        t, daily, ["restaurant_name", "cuisine_type", "pricing_for_two", "locality"], ["city", "state", "city_tier"]
    )
    city_day = Window.partitionBy("order_day", "city")
    orders, before = F.col("daily_orders"), F.col("orders_same_day_last_week")
    return named.select(
        "restaurant_id", "restaurant_name", "cuisine_type", "pricing_for_two", "locality", "city", "state", "city_tier",
        "order_day", "order_week", "order_month",
        "daily_orders", "daily_revenue",
        mean_of("daily_revenue", orders).alias("avg_order_value"),
        "unique_customers", "completed_orders", "cancelled_orders", "avg_processing_time",
        percent("completed_orders", orders).alias("completion_rate"),
        percent("cancelled_orders", orders).alias("cancellation_rate"),
        div0("unique_customers", orders).alias("customer_repeat_ratio"),
        "ma7_orders", "ma7_revenue", "orders_same_day_last_week",
        percent(orders - before, before).alias("wow_order_growth_pct"),
        "mtd_orders", "mtd_revenue",
        F.dense_rank().over(city_day.orderBy(orders.desc())).cast("long").alias("city_daily_order_rank"),
        F.dense_rank().over(city_day.orderBy(F.col("daily_revenue").desc())).cast("long").alias("city_daily_revenue_rank"),
        buckets.daily_tier(orders, F.col("daily_revenue")).alias("performance_tier"),
    )


# Statuses whose duration is reported.
TIMED_STATUSES = ["PENDING", "CONFIRMED", "PREPARING", "READY", "OUT_FOR_DELIVERY"]


def order_status_analysis(t: Tables) -> DataFrame:
    # the history of one order is the few steps of its life
    steps = with_features(
        t["order_history"], ["order_id"], ["status_changed_at", "new_status"], [lag("_before", "status_changed_at")], bounded=True
    ).withColumn("_minutes", boundary_diff("minute", "_before", "status_changed_at"))
    durations = steps.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("total_status_changes"),
        F.min("status_changed_at").alias("first_status_change_time"),
        *[
            F.sum(F.when(F.col("old_status") == s, F.col("_minutes")).otherwise(0)).alias(f"minutes_in_{s.lower()}")
            for s in TIMED_STATUSES
        ],
    )
    orders = current(t["fact_order"]).join(durations, "order_id", "left")
    named = lookup(orders, current(t["dim_customer"]), "customer_id", ["customer_name"])
    named = _restaurant(t, named, ["restaurant_name", "cuisine_type"])
    status, changes = F.col("order_status"), F.col("total_status_changes")
    minutes = boundary_diff("minute", "created_at", "updated_at")
    timed = [
        F.when(changes.isNull(), 0).otherwise(F.col(f"minutes_in_{s.lower()}")).alias(f"minutes_in_{s.lower()}")
        for s in TIMED_STATUSES
    ]
    return named.select(
        "order_id", "order_date", "customer_id", "customer_name", "restaurant_id", "restaurant_name", "cuisine_type",
        "total_amount", status.alias("current_status"), status.alias("initial_status"),
        F.col("updated_at").alias("status_updated_at"),
        "total_status_changes",
        *timed,
        minutes.alias("total_processing_time_mins"),
        "first_status_change_time",
        boundary_diff("minute", "created_at", "first_status_change_time").alias("minutes_to_first_status_change"),
        buckets.status_velocity(changes).alias("status_change_velocity"),
        buckets.cancellation_stage(status, changes).alias("cancellation_stage"),
        buckets.order_outcome(status, minutes).alias("order_outcome"),
    )


ORDER_SUMMARY_PARTS = ("customer", "restaurant", "delivery", "calendar", "numbers")


def order_summary(t: Tables, parts: Collection[str] = ORDER_SUMMARY_PARTS) -> DataFrame:
    """Wide order rows: one per order and delivery.

    Reports name the ``parts`` they read, so that joins they do not need are left
    out; a dimension join never changes the rows.
    """
    status = F.col("order_status")
    # Orders are moved by customer, restaurant and order: what follows from their own columns is worked out behind that.
    given = [
        "order_id", "order_date", "total_amount", "customer_id", "restaurant_id", "order_status", "payment_method", "created_at", "updated_at",
    ]
    rows = current(t["fact_order"]).select(*given)
    derived = [
        "order_id", "order_date", _day().alias("order_date_key"), "total_amount", "customer_id", "restaurant_id",
        status.alias("current_status"), status.alias("initial_status"), "payment_method",
        F.col("updated_at").alias("status_updated_at"),
        buckets.order_value_segment(F.col("total_amount")).alias("order_value_segment"),
        buckets.flag(status == "COMPLETED").alias("is_completed"),
        buckets.flag(status == "CANCELLED").alias("is_cancelled"),
        buckets.flag(status == "PENDING").alias("is_pending"),
        boundary_diff("minute", "created_at", "updated_at").alias("order_processing_time_mins"),
    ]
    deliveries = current(t["fact_delivery"])
    if "numbers" in parts:
        # An order has a row per delivery: its numbers follow from the rows of the orders before it, and its own come next.
        narrow = current(t["fact_order"]).select("order_id", "order_date", "customer_id", "restaurant_id")
        per_order = deliveries.groupBy("order_id").agg(F.count(F.lit(1)).alias("_rows"))
        weigh = lambda df: df.join(per_order, "order_id", "left").fillna(1, ["_rows"]) if "delivery" in parts else df.withColumn("_rows", F.lit(1).cast("long"))
        rows, narrow = weigh(rows), weigh(narrow)
        for key in ("customer", "restaurant"):
            rows = with_features(rows, [f"{key}_id"], ["order_date", "order_id"], [running(f"_{key}_rows", "sum", "_rows")], facts=narrow)
    if "delivery" in parts:
        deliveries = deliveries.select(
            "order_id", "delivery_id", "delivery_agent_id", "delivery_date", "delivery_status",
            digits_to_int("estimated_time").alias("estimated_delivery_time_mins"),
        )
        actual, estimate = F.col("actual_delivery_time_mins"), F.col("estimated_delivery_time_mins")
        delivered = F.col("delivery_status") == "DELIVERED"
        if "numbers" in parts:  # one order has few deliveries
            deliveries = with_features(deliveries, ["order_id"], ["delivery_id"], [row_number("_nth")], bounded=True)
        rows = rows.join(deliveries, "order_id", "left")
    rows = rows.select(*derived, *[c for c in rows.columns if c not in given])
    if "delivery" in parts:
        rows = (
            rows.withColumn("actual_delivery_time_mins", boundary_diff("minute", "order_date", "delivery_date"))
            .withColumn("is_on_time_delivery", buckets.flag(delivered & (actual <= estimate)))
            .withColumn("is_delivered", buckets.flag(delivered))
        )
    if "numbers" in parts:
        nth = F.coalesce("_nth", F.lit(1)) if "delivery" in parts else F.lit(1)
        for key in ("customer", "restaurant"):
            rows = rows.withColumn(f"{key}_order_number", (F.col(f"_{key}_rows") - F.col("_rows") + nth).cast("long"))
        rows = rows.drop("_rows", "_nth", "_customer_rows", "_restaurant_rows")
    if "customer" in parts:
        customers = current(t["dim_customer"]).select(
            "customer_id", "customer_name", F.col("gender").alias("customer_gender"), "login_by_using", "dob"
        )
        rows = (
            rows.join(customers, "customer_id", "left")
            .withColumn("customer_age_at_order", boundary_diff("year", "dob", "order_date"))
            .drop("dob")
        )
    if "restaurant" in parts:
        restaurants = lookup(
            current(t["dim_restaurant"]), current(t["dim_location"]), "location_id", ["city", "state", "city_tier", "zip_code"]
        ).select(
            "restaurant_id", "restaurant_name", "cuisine_type", F.col("pricing_for_two").alias("restaurant_pricing"),
            F.col("locality").alias("restaurant_locality"), "city", "state", "city_tier", "zip_code",
        )
        rows = rows.join(restaurants, "restaurant_id", "left")
    if "calendar" in parts:
        day, hour = F.col("order_date_key"), F.hour("order_date")
        rows = rows.select("*", *calendar_columns(day), hour.alias("order_hour"), buckets.time_of_day(hour).alias("time_of_day"))
        rows = rows.drop("day_of_year", "day_of_the_month").withColumn("day_type", buckets.day_type(F.col("day_of_week")))
    return rows


def order_time_analysis(t: Tables, crowding: bool = True) -> DataFrame:
    """Calendar and clock features; with ``crowding`` also counts and averages per slot.

    Averages per hour and weekday come from one small (day, hour) aggregate that
    is joined back: a window over 24 hours would have 24 tasks at any size.
    """
    orders = current(t["fact_order"]).select(
        "order_id", "order_date", _day().alias("order_date_key"), F.hour("order_date").alias("order_hour"),
        F.minute("order_date").alias("order_minute"), "customer_id", "restaurant_id", "total_amount",
        F.col("order_status").alias("current_status"), "payment_method",
    )
    day, hour = F.col("order_date_key"), F.col("order_hour")
    rows = orders.select("*", *calendar_columns(day))
    if crowding:
        slots = orders.groupBy(day, hour).agg(F.count("order_id").alias("_n"), F.sum("total_amount").alias("_sum"))
        busy = slots.select("order_date_key", "order_hour", F.col("_n").alias("orders_in_same_hour"))
        by_hour = slots.groupBy("order_hour").agg(
            mean_of(F.sum("_sum"), F.sum("_n")).alias("avg_order_value_for_hour")
        )
        by_weekday = slots.groupBy(buckets.iso_weekday(day).alias("day_of_week")).agg(
            mean_of(F.sum("_sum"), F.sum("_n")).alias("avg_order_value_for_day")
        )
        rows = rows.join(busy, ["order_date_key", "order_hour"], "left")
        rows = rows.join(by_hour, "order_hour", "left").join(by_weekday, "day_of_week", "left")
        slot, visit = ["restaurant_id", "order_date_key", "order_hour"], ["customer_id", "order_date_key"]
        rows = with_totals(rows, orders, slot, F.count("order_id").alias("restaurant_orders_in_same_hour"))
        rows = with_totals(rows, orders, visit, F.count("order_id").alias("customer_orders_same_day"))
    named = _restaurant(t, rows, ["restaurant_name", "cuisine_type"], ["city", "state"])
    return named.select(
        "*",
        buckets.time_of_day(hour).alias("time_of_day"),
        buckets.day_type(F.col("day_of_week")).alias("day_type"),
        buckets.day_category(F.col("day_of_week")).alias("day_category"),
        buckets.meal_time(hour).alias("meal_time"),
        buckets.peak_indicator(hour).alias("peak_indicator"),
        buckets.season(F.col("month")).alias("season"),
        buckets.month_period(F.col("day_of_the_month")).alias("month_period"),
    )
