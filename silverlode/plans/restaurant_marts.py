"""Restaurant marts: cuisines, menus, lifetime performance, time slots."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from silverlode.functions import buckets
from silverlode.functions.scalar import boundary_diff, div0, mean_of, percent
from silverlode.operators.joins import current, lookup
from silverlode.operators.sequence import row_number, total, with_features

Tables = Mapping[str, DataFrame]


def cuisine_performance(t: Tables) -> DataFrame:
    """By cuisine and city, from orders reduced to (restaurant, customer)."""
    place = ["cuisine_type", "city", "state", "city_tier"]
    pairs = current(t["fact_order"]).groupBy("restaurant_id", "customer_id").agg(
        F.count("order_id").alias("_n"), F.sum("total_amount").alias("_sum")
    )
    restaurants = lookup(
        current(t["dim_restaurant"]), current(t["dim_location"]), "location_id", ["city", "state", "city_tier"]
    ).select("restaurant_id", "pricing_for_two", *place)
    per_restaurant = pairs.groupBy("restaurant_id").agg(F.sum("_n").alias("_n"), F.sum("_sum").alias("_sum"))
    # A restaurant without orders still counts once in the average price.
    weight = F.greatest(F.coalesce("_n", F.lit(0)), F.lit(1))
    sums = restaurants.join(per_restaurant, "restaurant_id", "left").groupBy(*place).agg(
        F.count("restaurant_id").alias("restaurant_count"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_orders"),
        F.sum("_sum").alias("total_revenue"),
        (
            F.sum(F.col("pricing_for_two") * weight).cast("double")
            / F.sum(F.when(F.col("pricing_for_two").isNotNull(), weight))
        ).alias("avg_pricing_for_two"),
    )
    buyers = (
        pairs.join(restaurants.select("restaurant_id", *place), "restaurant_id")
        .groupBy(*[F.col(c).alias(f"_{c}") for c in place])
        .agg(F.count_distinct("customer_id").alias("unique_customers"))
    )
    same = F.lit(True)
    for column in place:
        same = same & F.col(column).eqNullSafe(F.col(f"_{column}"))
    share = percent("total_revenue", F.sum("total_revenue").over(Window.partitionBy("city")))
    return sums.join(buyers, same, "left").select(
        *place,
        "restaurant_count",
        "total_orders",
        "total_revenue",
        mean_of("total_revenue", "total_orders").alias("avg_order_value"),
        div0("total_orders", "restaurant_count").alias("avg_orders_per_restaurant"),
        div0("total_revenue", "restaurant_count").alias("avg_revenue_per_restaurant"),
        F.coalesce("unique_customers", F.lit(0)).alias("unique_customers"),
        "avg_pricing_for_two",
        share.alias("city_market_share_pct"),
    )


def menu_performance(t: Tables) -> DataFrame:
    """Menu items with the orders of their restaurant and their own item orders.

    Orders are aggregated per restaurant before the join: menu times orders would explode.
    Windows run over menu items only, and a restaurant's menu is small.
    """
    per_restaurant = current(t["fact_order"]).groupBy("restaurant_id").agg(
        F.count("order_id").alias("estimated_orders"), F.sum("total_amount").alias("_sum")
    )
    per_item = t["fact_order_item"].groupBy("menu_id").agg(F.count_distinct("order_id").alias("item_orders"))
    menu = (
        current(t["dim_menu"])
        .join(per_restaurant, "restaurant_id", "left")
        .join(per_item, "menu_id", "left")
        .fillna(0, ["estimated_orders", "item_orders"])
        .withColumn("_revenue", F.col("price") * F.col("estimated_orders"))
    )
    ranked = with_features(
        menu, ["restaurant_id", "category"], ["menu_id"], [total("avg_category_price", "avg", "price")], bounded=True
    )
    ranked = with_features(ranked, ["restaurant_id"], ["estimated_orders desc", "menu_id"], [row_number("popularity_rank")], bounded=True)
    ranked = with_features(ranked, ["restaurant_id"], ["_revenue desc", "menu_id"], [row_number("revenue_rank")], bounded=True)
    named = lookup(ranked, current(t["dim_restaurant"]), "restaurant_id", ["restaurant_name"])
    orders = F.nullif(F.col("estimated_orders"), F.lit(0))
    return named.select(
        "menu_id", "restaurant_id", "restaurant_name", "item_name", "category", "price", "item_type", "availability",
        "estimated_orders", "item_orders",
        div0("_sum", orders).alias("avg_order_with_item"),
        "avg_category_price",
        percent("price", F.nullif(F.col("avg_category_price"), F.lit(0.0))).alias("price_index"),
        "popularity_rank", "revenue_rank",
    )


def restaurant_performance(t: Tables) -> DataFrame:
    """Lifetime metrics, from orders reduced to (restaurant, day) and (restaurant, customer)."""
    orders, status = current(t["fact_order"]), F.col("order_status")
    daily = orders.groupBy("restaurant_id", F.to_date("order_date").alias("_day")).agg(
        F.count("order_id").alias("total_orders"),
        F.sum("total_amount").alias("total_revenue"),
        F.count_if(status == "COMPLETED").alias("completed_orders"),
        F.count_if(status == "CANCELLED").alias("cancelled_orders"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )
    lifetime = daily.groupBy("restaurant_id").agg(
        *[F.sum(c).alias(c) for c in ("total_orders", "total_revenue", "completed_orders", "cancelled_orders")],
        F.min("first_order_date").alias("first_order_date"),
        F.max("last_order_date").alias("last_order_date"),
        F.count("_day").alias("_days"),
    )
    buyers = orders.groupBy("restaurant_id").agg(F.count_distinct("customer_id").alias("unique_customers"))
    counts = ["total_orders", "unique_customers", "completed_orders", "cancelled_orders"]
    joined = (
        lookup(current(t["dim_restaurant"]), current(t["dim_location"]), "location_id", ["city", "state", "city_tier"])
        .join(lifetime, "restaurant_id", "left")
        .join(buyers, "restaurant_id", "left")
        .fillna(0, counts)
    )
    total_orders, days = F.col("total_orders"), F.nullif(F.col("_days"), F.lit(0))
    average = mean_of("total_revenue", total_orders)
    return joined.select(
        "restaurant_id", "restaurant_name", "cuisine_type", "pricing_for_two", "locality", "city", "state", "city_tier",
        "open_status", "total_orders", "unique_customers", "total_revenue",
        average.alias("avg_order_value"),
        div0(total_orders, "unique_customers").alias("orders_per_customer"),
        "completed_orders", "cancelled_orders",
        percent("cancelled_orders", total_orders).alias("cancellation_rate"),
        "first_order_date", "last_order_date",
        boundary_diff("day", "first_order_date", "last_order_date").alias("operational_days"),
        div0(total_orders, days).alias("avg_orders_per_day"),
        div0("total_revenue", days).alias("avg_revenue_per_day"),
        buckets.restaurant_tier(total_orders, average).alias("restaurant_tier"),
    )


def restaurant_time_performance(t: Tables) -> DataFrame:
    day = F.to_date("order_date")
    slots = current(t["fact_order"]).groupBy(
        "restaurant_id",
        F.dayname(day).alias("day_name"),
        buckets.iso_weekday(day).alias("day_of_week"),
        F.hour("order_date").alias("order_hour"),
    ).agg(
        F.count("order_id").alias("total_orders"),
        F.sum("total_amount").alias("total_revenue"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.count_if(F.col("order_status") == "COMPLETED").alias("completed_orders"),
    )
    named = lookup(slots, current(t["dim_restaurant"]), "restaurant_id", ["restaurant_name", "cuisine_type"], "inner")
    # At most 7 x 24 slots per restaurant.
    by_orders = Window.partitionBy("restaurant_id").orderBy(F.col("total_orders").desc(), "day_of_week", "order_hour")
    return named.select(
        "restaurant_id", "restaurant_name", "cuisine_type", "day_name", "day_of_week",
        buckets.day_type(F.col("day_of_week")).alias("day_type"),
        "order_hour",
        buckets.time_of_day(F.col("order_hour")).alias("time_of_day"),
        "total_orders", "total_revenue",
        mean_of("total_revenue", "total_orders").alias("avg_order_value"),
        "unique_customers", "completed_orders",
        percent("completed_orders", "total_orders").alias("completion_rate"),
        F.row_number().over(by_orders).cast("long").alias("peak_time_rank"),
    )
