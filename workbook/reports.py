"""Dashboard and sample reports with their checks."""

from pyspark.sql import functions as F

from silverlode.plans import customer_marts, delivery_marts, operations, order_marts, reports as r, restaurant_marts
from workbook.core import ORDER_AS_OF, case
from workbook.customer import COHORT_SQL, SUMMARY_SQL as CUSTOMER_SQL
from workbook.delivery import AGENT_SQL, TIME_SQL as DELIVERY_TIME_SQL
from workbook.orders import VALUE_SEGMENT, hour_label, weekend
from workbook.restaurant import CUISINE_SQL, PERFORMANCE_SQL

START, END = "1996-01-01 00:00:00", "1999-12-31 00:00:00"
E_START, E_END = "2024-01-05 00:00:00", "2024-01-25 00:00:00"
RANGE = f"o.order_date BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{END}'"
E_RANGE = f"cast(o.order_date AS date) BETWEEN DATE '{E_START[:10]}' AND DATE '{E_END[:10]}'"
# Order summary rows: one per order and delivery.
ROWS = "fact_order o LEFT JOIN fact_delivery fd ON o.order_id = fd.order_id"
AMOUNT = "cast(sum(o.total_amount) AS double)"
AVERAGE = "cast(sum(o.total_amount) AS double) / count(o.total_amount)"


def summary(t, *parts):
    return r.between(order_marts.order_summary(t, ("delivery", *parts)), START, END)


def slots(t):
    return r.between_days(order_marts.order_time_analysis(t.using(fact_order="event_order"), crowding=False), E_START, E_END)


def wrap(inner: str, outer: str) -> str:
    """A report over a mart's check SQL."""
    return f"SELECT * FROM (WITH mart AS ({inner}) {outer})"


@case(
    "d1_executive_kpis",
    f"SELECT count(DISTINCT o.order_id) AS total_orders, {AMOUNT} AS total_revenue, {AVERAGE} AS avg_order_value, count(DISTINCT o.customer_id) AS unique_customers FROM {ROWS} WHERE {RANGE}",
)
def _(t):
    return r.executive_kpis(summary(t))


@case(
    "d2_daily_orders",
    f"SELECT cast(o.order_date AS date) AS order_day, count(DISTINCT o.order_id) AS orders, {AMOUNT} AS revenue FROM {ROWS} WHERE {RANGE} GROUP BY 1",
)
def _(t):
    return r.daily_orders(summary(t))


@case(
    "d3_orders_by_time_of_day",
    f"SELECT {hour_label('o.order_date')} AS time_of_day, count(DISTINCT o.order_id) AS orders FROM event_order o WHERE {E_RANGE} GROUP BY 1",
)
def _(t):
    return r.orders_by(slots(t), "time_of_day", r.TIMES)


@case("d4_top_restaurants", wrap(PERFORMANCE_SQL, "SELECT restaurant_name, total_orders, total_revenue, avg_order_value FROM mart ORDER BY total_orders DESC, restaurant_name LIMIT 5"))
def _(t):
    return r.top_restaurants(restaurant_marts.restaurant_performance(t))


@case("d5_top_cuisines_by_orders", wrap(CUISINE_SQL, "SELECT cuisine_type, city, total_orders, total_revenue FROM mart ORDER BY total_orders DESC, cuisine_type, city LIMIT 5"))
def _(t):
    return r.top_cuisines(restaurant_marts.cuisine_performance(t), "total_orders", 5)


LTV = "cast(sum(cast(lifetime_value AS decimal(38,2))) AS double) / count(lifetime_value)"


@case(
    "d6_customer_kpis",
    wrap(CUSTOMER_SQL, f"""SELECT count(DISTINCT customer_id) AS total_customers, {LTV} AS avg_ltv, cast(sum(total_orders) AS double) / count(*) AS avg_orders_per_customer,
      cast(sum(CASE WHEN customer_status = 'ACTIVE' THEN 1 ELSE 0 END) AS bigint) AS active_customers FROM mart"""),
)
def _(t):
    return r.customer_kpis(customer_marts.customer_order_summary(t, ORDER_AS_OF))


@case("d7_customer_segments", wrap(CUSTOMER_SQL, f"SELECT customer_segment, count(DISTINCT customer_id) AS customers, {LTV} AS avg_ltv FROM mart GROUP BY 1"))
def _(t):
    return r.customer_segments(customer_marts.customer_order_summary(t, ORDER_AS_OF))


@case("d8_customer_statuses", wrap(CUSTOMER_SQL, "SELECT customer_status, count(DISTINCT customer_id) AS customers FROM mart GROUP BY 1"))
def _(t):
    return r.customer_statuses(customer_marts.customer_order_summary(t, ORDER_AS_OF))


D9_AS_OF = "1995-12-01"
RETENTION = f"""SELECT cohort_month, months_since_first_order, avg(retention_rate) AS retention_rate FROM mart
  WHERE cohort_month >= DATE '{D9_AS_OF}' - INTERVAL '6' MONTH GROUP BY 1, 2"""


@case("d9_cohort_retention", wrap(COHORT_SQL, RETENTION))
def _(t):
    return r.cohort_retention(customer_marts.customer_cohort(t), D9_AS_OF)


@case(
    "a12_cohort_matrix",
    wrap(COHORT_SQL, "SELECT cohort_month, coalesce(string_agg(months_since_first_order || ':' || cast(round(retention_rate * 1000000) AS bigint), ',' ORDER BY months_since_first_order) FILTER (months_since_first_order > 36), '') AS later, " + ", ".join(
        f"max(CASE WHEN months_since_first_order = {m} THEN retention_rate END) AS month_{m}" for m in range(37)
    ) + f" FROM mart WHERE cohort_month >= DATE '{D9_AS_OF}' - INTERVAL '6' MONTH GROUP BY 1"),
)
def _(t):
    matrix = r.cohort_matrix(customer_marts.customer_cohort(t), D9_AS_OF, last_month=36)
    # the months beyond the last column, each with its rate in millionths
    cell = lambda e: F.concat(e["key"].cast("string"), F.lit(":"), F.round(e["value"] * 1_000_000).cast("long").cast("string"))
    return matrix.withColumn("later", F.array_join(F.transform(F.array_sort(F.map_entries("later")), cell), ","))


@case(
    "d10_restaurant_kpis",
    wrap(PERFORMANCE_SQL, """SELECT count(DISTINCT restaurant_id) AS total_restaurants, cast(sum(total_orders) AS double) / count(*) AS avg_orders,
      round(avg(avg_order_value), 4) AS avg_order_value, round(avg(cancellation_rate), 6) AS avg_cancel_rate FROM mart"""),
)
def _(t):
    from pyspark.sql import functions as F

    kpis = r.restaurant_kpis(restaurant_marts.restaurant_performance(t))
    return kpis.withColumn("avg_order_value", F.round("avg_order_value", 4)).withColumn("avg_cancel_rate", F.round("avg_cancel_rate", 6))


@case("d11_restaurant_tiers", wrap(PERFORMANCE_SQL, "SELECT restaurant_tier, count(DISTINCT restaurant_id) AS restaurants, cast(sum(cast(total_revenue AS decimal(38,2))) AS double) / count(total_revenue) AS avg_revenue FROM mart GROUP BY 1"))
def _(t):
    return r.restaurant_tiers(restaurant_marts.restaurant_performance(t))


@case("d12_top_cuisines_by_revenue", wrap(CUISINE_SQL, "SELECT cuisine_type, city, total_orders, total_revenue FROM mart ORDER BY total_revenue DESC NULLS LAST, cuisine_type, city LIMIT 8"))
def _(t):
    return r.top_cuisines(restaurant_marts.cuisine_performance(t), "total_revenue", 8)


@case("d13_cities", wrap(PERFORMANCE_SQL, "SELECT DISTINCT city FROM mart"))
def _(t):
    return r.restaurant_cities(restaurant_marts.restaurant_performance(t))


TABLE = "SELECT restaurant_name, cuisine_type, city, total_orders, total_revenue, avg_order_value, cancellation_rate, restaurant_tier FROM mart {} ORDER BY total_revenue DESC NULLS LAST, restaurant_name LIMIT 20"


@case("d14_restaurant_table", wrap(PERFORMANCE_SQL, TABLE.format("")))
def _(t):
    return r.restaurant_table(restaurant_marts.restaurant_performance(t))


@case("d14_restaurant_table_of_city", wrap(PERFORMANCE_SQL, TABLE.format("WHERE city = 'NATION_3'")))
def _(t):
    return r.restaurant_table(restaurant_marts.restaurant_performance(t), "NATION_3")


def times(t):
    return r.between(delivery_marts.delivery_time_analysis(t), START, END, "delivery_date")


D_RANGE = f"WHERE delivery_date BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{END}'"


@case(
    "d15_delivery_kpis",
    wrap(DELIVERY_TIME_SQL, f"""SELECT count(DISTINCT delivery_id) AS total_deliveries, cast(sum(CASE WHEN delivery_timeliness = 'ON_TIME' THEN 1 ELSE 0 END) AS double) / count(*) * 100 AS on_time_pct,
      cast(sum(actual_delivery_time_mins) AS double) / count(actual_delivery_time_mins) AS avg_delivery_time, cast(sum(time_variance_mins) AS double) / count(time_variance_mins) AS avg_variance FROM mart {D_RANGE}"""),
)
def _(t):
    return r.delivery_kpis(times(t))


@case("d16_delivery_timeliness", wrap(DELIVERY_TIME_SQL, f"SELECT delivery_timeliness, count(DISTINCT delivery_id) AS deliveries FROM mart {D_RANGE} GROUP BY 1"))
def _(t):
    return r.delivery_timeliness(times(t))


@case("d17_agent_tiers", wrap(AGENT_SQL, "SELECT performance_tier, count(DISTINCT delivery_agent_id) AS agents, round(avg(success_rate), 6) AS avg_success_rate FROM mart GROUP BY 1"))
def _(t):
    from pyspark.sql import functions as F

    return r.agent_tiers(delivery_marts.delivery_agent_performance(t)).withColumn("avg_success_rate", F.round("avg_success_rate", 6))


@case(
    "d18_top_agents",
    wrap(AGENT_SQL, """SELECT delivery_agent_name, city, coalesce(total_deliveries, 0) AS total_deliveries, coalesce(successful_deliveries, 0) AS successful_deliveries,
      coalesce(success_rate, 0) AS success_rate, coalesce(avg_estimated_time_mins, 0) AS avg_estimated_time_mins, performance_tier FROM mart ORDER BY successful_deliveries DESC, delivery_agent_name LIMIT 15"""),
)
def _(t):
    return r.top_agents(delivery_marts.delivery_agent_performance(t))


@case(
    "d19_order_kpis",
    f"""SELECT count(DISTINCT o.order_id) AS total_orders, cast(sum(CASE WHEN o.order_status = 'COMPLETED' THEN 1 ELSE 0 END) AS bigint) AS completed_orders,
      cast(sum(CASE WHEN o.order_status = 'CANCELLED' THEN 1 ELSE 0 END) AS bigint) AS cancelled_orders,
      cast(sum(date_diff('minute', o.created_at, o.updated_at)) AS double) / count(*) AS avg_process_time FROM {ROWS} WHERE {RANGE}""",
)
def _(t):
    return r.order_kpis(summary(t))


@case("d20_value_segments", f"SELECT {VALUE_SEGMENT} AS order_value_segment, count(DISTINCT o.order_id) AS orders, {AMOUNT} AS revenue FROM {ROWS} WHERE {RANGE} GROUP BY 1")
def _(t):
    return r.value_segments(summary(t))


@case("d21_orders_by_hour", f"SELECT hour(o.order_date) AS order_hour, count(DISTINCT o.order_id) AS orders FROM event_order o WHERE {E_RANGE} GROUP BY 1")
def _(t):
    return r.orders_by(slots(t), "order_hour")


@case("d22_day_types", f"SELECT {weekend('o.order_date')} AS day_type, count(DISTINCT o.order_id) AS orders, {AVERAGE} AS avg_value FROM {ROWS} WHERE {RANGE} GROUP BY 1")
def _(t):
    return r.day_types(summary(t, "calendar"))


@case(
    "d23_meal_times",
    f"""SELECT CASE WHEN hour(o.order_date) BETWEEN 7 AND 10 THEN 'BREAKFAST' WHEN hour(o.order_date) BETWEEN 11 AND 14 THEN 'LUNCH' WHEN hour(o.order_date) BETWEEN 16 AND 18 THEN 'SNACK'
      WHEN hour(o.order_date) BETWEEN 19 AND 22 THEN 'DINNER' ELSE 'LATE_NIGHT' END AS meal_time, count(DISTINCT o.order_id) AS orders FROM event_order o WHERE {E_RANGE} GROUP BY 1""",
)
def _(t):
    return r.orders_by(slots(t), "meal_time", r.MEALS)


@case(
    "d24_revenue_kpis",
    f"SELECT {AMOUNT} AS total_revenue, {AVERAGE} AS avg_order_value, {AMOUNT} / count(DISTINCT o.customer_id) AS revenue_per_customer, count(DISTINCT o.order_id) AS total_orders FROM {ROWS} WHERE {RANGE}",
)
def _(t):
    return r.revenue_kpis(summary(t))


@case(
    "d25_revenue_trend",
    f"SELECT cast(o.order_date AS date) AS order_day, {AMOUNT} AS daily_revenue, count(DISTINCT o.order_id) AS daily_orders, {AVERAGE} AS avg_order_value FROM {ROWS} WHERE {RANGE} GROUP BY 1",
)
def _(t):
    return r.revenue_trend(summary(t))


@case(
    "d26_revenue_by_payment",
    f"""SELECT CASE WHEN o.payment_method IN ('CARD', 'CREDIT_CARD', 'DEBIT_CARD') THEN 'CARD' WHEN o.payment_method IN ('UPI', 'GPAY', 'PHONEPE', 'PAYTM') THEN 'UPI'
      WHEN o.payment_method IN ('CASH', 'WALLET', 'NET_BANKING') THEN o.payment_method ELSE 'OTHER' END AS payment_category, {AMOUNT} AS revenue, count(DISTINCT o.order_id) AS orders FROM fact_order o WHERE {RANGE} GROUP BY 1""",
)
def _(t):
    return r.revenue_by(r.between(order_marts.order_payment(t), START, END), "payment_category")


PLACED = f"{ROWS} LEFT JOIN dim_restaurant r ON o.restaurant_id = r.restaurant_id LEFT JOIN dim_location l ON r.location_id = l.location_id WHERE {RANGE}"


@case("d27_revenue_by_city_tier", f"SELECT l.city_tier, {AMOUNT} AS revenue, count(DISTINCT o.order_id) AS orders FROM {PLACED} GROUP BY 1")
def _(t):
    return r.revenue_by(summary(t, "restaurant"), "city_tier")


@case(
    "d28_top_cities",
    f"""SELECT l.city, {AMOUNT} AS total_revenue, count(DISTINCT o.order_id) AS total_orders, {AVERAGE} AS avg_order_value, count(DISTINCT o.customer_id) AS unique_customers
      FROM {PLACED} GROUP BY 1 ORDER BY total_revenue DESC, l.city LIMIT 10""",
)
def _(t):
    return r.top_cities(summary(t, "restaurant"))


@case(
    "x1_daily_metrics",
    "SELECT cast(order_date AS date) AS order_day, count(DISTINCT order_id) AS total_orders, cast(sum(total_amount) AS double) AS revenue, count(DISTINCT customer_id) AS unique_customers FROM fact_order WHERE order_status = 'COMPLETED' GROUP BY 1",
)
def _(t):
    return r.daily_metrics(t["fact_order"], "COMPLETED")


@case(
    "x2_top_restaurants_by_items",
    """SELECT r.restaurant_name, count(DISTINCT o.order_id) AS order_count, cast(sum(o.total_amount) AS double) / count(*) AS avg_order_value, cast(sum(oi.subtotal) AS double) AS total_revenue
      FROM fact_order o JOIN dim_restaurant r ON o.restaurant_id = r.restaurant_id JOIN fact_order_item oi ON o.order_id = oi.order_id GROUP BY 1 ORDER BY total_revenue DESC, r.restaurant_name LIMIT 10""",
)
def _(t):
    return r.top_restaurants_by_items(t)


@case(
    "x3_stuck_deliveries",
    """SELECT delivery_id, order_id, delivery_status AS current_status, updated_at AS status_updated_at, date_diff('minute', updated_at, TIMESTAMP '2001-08-01') AS stuck_minutes
      FROM fact_delivery WHERE delivery_status IN ('ASSIGNED', 'PICKED_UP', 'IN_TRANSIT') AND date_diff('minute', updated_at, TIMESTAMP '2001-08-01') > 60""",
)
def _(t):
    return r.stuck_deliveries(t["fact_delivery"], ORDER_AS_OF)


@case(
    "x4_failed_runs",
    """SELECT ingest_run_id, pipeline_name, run_status, source_row_count, valid_row_count, invalid_row_count, cast(execution_duration_sec AS double) AS execution_duration_sec, executed_at
      FROM ingest_run WHERE run_status = 'FAILED'""",
)
def _(t):
    return operations.failed_runs(t["ingest_run"])


