"""Order marts and their checks."""

from silverlode.plans import order_marts as m
from workbook.core import EVENT_AS_OF, ORDER_AS_OF, case

ESTIMATE = "try_cast(regexp_replace(fd.estimated_time, '[^0-9]', '', 'g') AS bigint)"


def hour_label(column: str) -> str:
    return (
        f"CASE WHEN hour({column}) BETWEEN 6 AND 11 THEN 'MORNING' WHEN hour({column}) BETWEEN 12 AND 16 THEN 'AFTERNOON' "
        f"WHEN hour({column}) BETWEEN 17 AND 21 THEN 'EVENING' ELSE 'NIGHT' END"
    )


def weekend(column: str) -> str:
    return f"CASE WHEN isodow({column}) IN (6, 7) THEN 'WEEKEND' ELSE 'WEEKDAY' END"


VALUE_SEGMENT = (
    "CASE WHEN o.total_amount < 200 THEN 'LOW_VALUE' WHEN o.total_amount < 500 THEN 'MEDIUM_VALUE' "
    "WHEN o.total_amount < 1000 THEN 'HIGH_VALUE' ELSE 'PREMIUM' END"
)

COHORT_SQL = """
WITH firsts AS (
  SELECT customer_id, min(order_date) AS first_date, date_trunc('month', min(order_date)) AS cohort_month, min(restaurant_id) AS first_restaurant,
    min(total_amount) AS first_amount FROM fact_order GROUP BY customer_id),
co AS (
  SELECT f.*, o.order_id, o.total_amount, o.restaurant_id, date_trunc('month', o.order_date) AS order_month,
    date_diff('month', f.cohort_month, date_trunc('month', o.order_date)) AS age, date_diff('day', f.first_date, o.order_date) AS days
  FROM firsts f JOIN fact_order o ON f.customer_id = o.customer_id),
cells AS (
  SELECT cohort_month, order_month, age, count(DISTINCT customer_id) AS active_customers, count(DISTINCT order_id) AS total_orders, sum(total_amount) AS revenue,
    cast(sum(first_amount) AS double) / count(*) AS avg_first_order_amount,
    cast(sum(CASE WHEN restaurant_id = first_restaurant THEN 1 ELSE 0 END) AS bigint) AS loyal,
    cast(sum(days) AS double) / count(days) AS avg_days
  FROM co GROUP BY ALL)
SELECT cast(cohort_month AS date) AS cohort_month, cast(order_month AS date) AS order_month, age AS months_since_first_order,
  first_value(active_customers) OVER w AS cohort_size, active_customers, total_orders, cast(revenue AS double) AS total_revenue,
  cast(active_customers AS double) / first_value(active_customers) OVER w * 100 AS retention_rate,
  cast(revenue AS double) / total_orders AS avg_order_value, cast(total_orders AS double) / active_customers AS orders_per_customer,
  cast(revenue AS double) / active_customers AS revenue_per_customer, avg_first_order_amount, loyal AS orders_from_first_restaurant,
  cast(loyal AS double) / total_orders * 100 AS first_restaurant_loyalty_rate,
  cast(sum(revenue) OVER w AS double) AS cumulative_cohort_revenue, avg_days AS avg_days_from_first_order
FROM cells WINDOW w AS (PARTITION BY cohort_month ORDER BY age)"""

JOURNEY_SQL = f"""
WITH s AS (
  SELECT *, row_number() OVER w AS seq, lag(order_date) OVER w AS prev_date, lag(restaurant_id) OVER w AS prev_restaurant,
    lag(total_amount) OVER w AS prev_amount, lead(order_date) OVER w AS next_date,
    count(restaurant_id) OVER r AS tried, sum(total_amount) OVER r AS spend, count(total_amount) OVER r AS spend_n, count(payment_method) OVER r AS methods
  FROM fact_order WINDOW w AS (PARTITION BY customer_id ORDER BY order_date, order_id),
    r AS (PARTITION BY customer_id ORDER BY order_date, order_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT s.order_id, s.customer_id, c.customer_name, c.gender, date_diff('year', c.dob, s.order_date) AS customer_age_at_order, s.order_date,
  cast(s.total_amount AS double) AS total_amount, s.order_status AS current_status, s.restaurant_id, r.restaurant_name, r.cuisine_type, l.city, l.state,
  seq AS order_sequence_number,
  CASE WHEN seq = 1 THEN 'FIRST_ORDER' WHEN seq = 2 THEN 'SECOND_ORDER' WHEN seq <= 5 THEN 'EARLY_ORDERS' WHEN seq <= 10 THEN 'REGULAR_CUSTOMER' ELSE 'LOYAL_CUSTOMER' END AS customer_journey_stage,
  date_diff('day', prev_date, s.order_date) AS days_since_last_order,
  CASE WHEN date_diff('day', prev_date, s.order_date) <= 1 THEN 'SAME_DAY' WHEN date_diff('day', prev_date, s.order_date) <= 7 THEN 'WITHIN_WEEK'
       WHEN date_diff('day', prev_date, s.order_date) <= 30 THEN 'WITHIN_MONTH' WHEN date_diff('day', prev_date, s.order_date) <= 90 THEN 'WITHIN_QUARTER' ELSE 'REACTIVATED' END AS order_frequency_type,
  cast(CASE WHEN s.restaurant_id = prev_restaurant THEN 1 ELSE 0 END AS bigint) AS is_repeat_restaurant, tried AS restaurants_tried_to_date,
  cast(prev_amount AS double) AS previous_order_amount, cast(s.total_amount - coalesce(prev_amount, 0) AS double) AS order_amount_change,
  CASE WHEN prev_amount IS NULL THEN 'FIRST_ORDER' WHEN s.total_amount > prev_amount THEN 'INCREASED' WHEN s.total_amount < prev_amount THEN 'DECREASED' ELSE 'SAME' END AS spending_trend,
  cast(spend AS double) AS cumulative_spend, cast(spend AS double) / spend_n AS avg_order_value_to_date, date_diff('day', s.order_date, next_date) AS days_until_next_order,
  CASE WHEN next_date IS NULL AND date_diff('day', s.order_date, TIMESTAMP '{ORDER_AS_OF}') > 90 THEN 'HIGH_CHURN_RISK'
       WHEN next_date IS NULL AND date_diff('day', s.order_date, TIMESTAMP '{ORDER_AS_OF}') > 30 THEN 'MEDIUM_CHURN_RISK'
       WHEN next_date IS NULL THEN 'LOW_CHURN_RISK' ELSE 'RETURNED' END AS churn_risk_level,
  s.payment_method, methods AS payment_methods_used_to_date, hour(s.order_date) AS order_hour, {hour_label('s.order_date')} AS time_of_day
FROM s LEFT JOIN dim_customer c ON s.customer_id = c.customer_id LEFT JOIN dim_restaurant r ON s.restaurant_id = r.restaurant_id
LEFT JOIN dim_location l ON r.location_id = l.location_id"""

ACTUAL = "date_diff('minute', o.order_date, fd.delivery_date)"

FULFILLMENT_SQL = f"""
WITH load AS (SELECT delivery_agent_id, cast(delivery_date AS date) AS day, count(DISTINCT delivery_id) AS n
  FROM fact_delivery fd JOIN fact_order o ON o.order_id = fd.order_id GROUP BY ALL)
SELECT o.order_id, o.order_date, o.customer_id, c.customer_name, o.restaurant_id, r.restaurant_name, r.cuisine_type,
  cast(o.total_amount AS double) AS total_amount, o.order_status, fd.delivery_id, fd.delivery_agent_id, da.delivery_agent_name, da.vehicle_type,
  cast(da.rating AS double) AS agent_rating, fd.delivery_date, fd.delivery_status, ca.locality AS delivery_locality, ca.city AS delivery_city,
  ca.zipcode AS delivery_zipcode, ca.address_type, r.locality AS restaurant_locality, l.city AS restaurant_city,
  {ESTIMATE} AS estimated_delivery_time_mins, {ACTUAL} AS actual_delivery_time_mins,
  date_diff('minute', o.created_at, o.updated_at) AS order_processing_time_mins, date_diff('minute', fd.created_at, fd.updated_at) AS delivery_processing_time_mins,
  {ACTUAL} - {ESTIMATE} AS delivery_time_variance_mins,
  CASE WHEN {ACTUAL} <= {ESTIMATE} THEN 'ON_TIME' WHEN {ACTUAL} <= {ESTIMATE} + 10 THEN 'SLIGHTLY_DELAYED' WHEN {ACTUAL} <= {ESTIMATE} + 20 THEN 'DELAYED' ELSE 'SEVERELY_DELAYED' END AS delivery_timeliness,
  CASE WHEN {ACTUAL} <= 30 THEN 'FAST' WHEN {ACTUAL} <= 45 THEN 'NORMAL' WHEN {ACTUAL} <= 60 THEN 'SLOW' ELSE 'VERY_SLOW' END AS delivery_speed,
  CASE WHEN ca.locality = r.locality THEN 'SAME_LOCALITY' WHEN ca.city = l.city THEN 'SAME_CITY' ELSE 'DIFFERENT_CITY' END AS delivery_distance_category,
  cast(CASE WHEN o.order_status = 'COMPLETED' AND fd.delivery_status = 'DELIVERED' THEN 1 ELSE 0 END AS bigint) AS is_successfully_fulfilled,
  cast(CASE WHEN o.order_status = 'CANCELLED' OR fd.delivery_status = 'FAILED' THEN 1 ELSE 0 END AS bigint) AS is_failed_fulfillment,
  hour(o.order_date) AS order_hour, {hour_label('o.order_date')} AS time_of_day, left(dayname(o.order_date), 3) AS day_name, {weekend('o.order_date')} AS day_type,
  coalesce(load.n, 0) AS agent_deliveries_same_day
FROM fact_order o LEFT JOIN fact_delivery fd ON o.order_id = fd.order_id LEFT JOIN dim_customer c ON o.customer_id = c.customer_id
LEFT JOIN dim_restaurant r ON o.restaurant_id = r.restaurant_id LEFT JOIN dim_location l ON r.location_id = l.location_id
LEFT JOIN dim_delivery_agent da ON fd.delivery_agent_id = da.delivery_agent_id
LEFT JOIN dim_customer_address ca ON fd.customer_address_id = ca.customer_address_id
LEFT JOIN load ON fd.delivery_agent_id = load.delivery_agent_id AND cast(fd.delivery_date AS date) = load.day"""

PAYMENT_SQL = f"""
SELECT o.order_id, o.order_date, cast(o.order_date AS date) AS order_date_key, o.customer_id, c.customer_name, o.restaurant_id, r.restaurant_name,
  cast(o.total_amount AS double) AS total_amount, o.payment_method, o.order_status AS current_status, l.city, l.state, l.city_tier,
  year(o.order_date) AS year, month(o.order_date) AS month, isodow(o.order_date) AS day_of_week, {weekend('o.order_date')} AS day_type, hour(o.order_date) AS order_hour,
  CASE WHEN o.payment_method IN ('CARD', 'CREDIT_CARD', 'DEBIT_CARD') THEN 'CARD' WHEN o.payment_method IN ('UPI', 'GPAY', 'PHONEPE', 'PAYTM') THEN 'UPI'
       WHEN o.payment_method IN ('CASH', 'WALLET', 'NET_BANKING') THEN o.payment_method ELSE 'OTHER' END AS payment_category,
  {VALUE_SEGMENT} AS order_value_segment,
  count(o.payment_method) OVER (PARTITION BY o.customer_id ORDER BY o.order_date, o.order_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS payment_methods_used_to_date,
  row_number() OVER (PARTITION BY o.customer_id, o.payment_method ORDER BY o.order_date, o.order_id) AS payment_method_use_count,
  cast(CASE WHEN row_number() OVER (PARTITION BY o.customer_id, o.payment_method ORDER BY o.order_date, o.order_id) = 1 THEN 1 ELSE 0 END AS bigint) AS is_first_use_of_payment_method,
  count(DISTINCT o.payment_method) OVER (PARTITION BY o.restaurant_id) AS restaurant_payment_methods_accepted,
  cast(CASE WHEN o.order_status = 'COMPLETED' THEN 1 ELSE 0 END AS bigint) AS payment_success,
  cast(CASE WHEN o.order_status = 'CANCELLED' AND o.payment_method IN ('CARD', 'UPI', 'NET_BANKING') THEN 1 ELSE 0 END AS bigint) AS potential_payment_failure,
  cast(sum(o.total_amount) OVER (PARTITION BY o.customer_id, o.payment_method) AS double) / count(o.total_amount) OVER (PARTITION BY o.customer_id, o.payment_method) AS customer_avg_order_value_by_payment,
  cast(sum(o.total_amount) OVER (PARTITION BY o.restaurant_id, o.payment_method) AS double) / count(o.total_amount) OVER (PARTITION BY o.restaurant_id, o.payment_method) AS restaurant_avg_order_value_by_payment
FROM fact_order o LEFT JOIN dim_customer c ON o.customer_id = c.customer_id LEFT JOIN dim_restaurant r ON o.restaurant_id = r.restaurant_id
LEFT JOIN dim_location l ON r.location_id = l.location_id"""

DAILY_SQL = """
WITH daily AS (
  SELECT restaurant_id, cast(order_date AS date) AS order_day, cast(date_trunc('week', order_date) AS date) AS order_week, cast(date_trunc('month', order_date) AS date) AS order_month,
    count(DISTINCT order_id) AS daily_orders, sum(total_amount) AS revenue, count(DISTINCT customer_id) AS unique_customers,
    cast(sum(CASE WHEN order_status = 'COMPLETED' THEN 1 ELSE 0 END) AS bigint) AS completed_orders,
    cast(sum(CASE WHEN order_status = 'CANCELLED' THEN 1 ELSE 0 END) AS bigint) AS cancelled_orders,
    cast(sum(date_diff('minute', created_at, updated_at)) AS double) / count(*) AS avg_processing_time
  FROM fact_order GROUP BY ALL),
w AS (
  SELECT *, cast(sum(daily_orders) OVER m AS double) / count(*) OVER m AS ma7_orders, cast(sum(revenue) OVER m AS double) / count(*) OVER m AS ma7_revenue,
    lag(daily_orders, 7) OVER (PARTITION BY restaurant_id ORDER BY order_day) AS before,
    cast(sum(daily_orders) OVER (PARTITION BY restaurant_id, order_month ORDER BY order_day) AS bigint) AS mtd_orders,
    cast(sum(revenue) OVER (PARTITION BY restaurant_id, order_month ORDER BY order_day) AS double) AS mtd_revenue
  FROM daily WINDOW m AS (PARTITION BY restaurant_id ORDER BY order_day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))
SELECT w.restaurant_id, r.restaurant_name, r.cuisine_type, cast(r.pricing_for_two AS double) AS pricing_for_two, r.locality, l.city, l.state, l.city_tier,
  order_day, order_week, order_month, daily_orders, cast(revenue AS double) AS daily_revenue, cast(revenue AS double) / daily_orders AS avg_order_value, unique_customers,
  completed_orders, cancelled_orders, avg_processing_time, cast(completed_orders AS double) / daily_orders * 100 AS completion_rate,
  cast(cancelled_orders AS double) / daily_orders * 100 AS cancellation_rate, cast(unique_customers AS double) / daily_orders AS customer_repeat_ratio,
  ma7_orders, ma7_revenue, before AS orders_same_day_last_week,
  CASE WHEN before = 0 THEN 0.0 ELSE cast(daily_orders - before AS double) / before END * 100 AS wow_order_growth_pct, mtd_orders, mtd_revenue,
  dense_rank() OVER (PARTITION BY order_day, l.city ORDER BY daily_orders DESC) AS city_daily_order_rank,
  dense_rank() OVER (PARTITION BY order_day, l.city ORDER BY revenue DESC) AS city_daily_revenue_rank,
  CASE WHEN daily_orders >= 50 AND revenue >= 25000 THEN 'TOP_PERFORMER' WHEN daily_orders >= 20 AND revenue >= 10000 THEN 'HIGH_PERFORMER'
       WHEN daily_orders >= 10 THEN 'AVERAGE_PERFORMER' ELSE 'LOW_PERFORMER' END AS performance_tier
FROM w LEFT JOIN dim_restaurant r ON w.restaurant_id = r.restaurant_id LEFT JOIN dim_location l ON r.location_id = l.location_id"""


def _minutes_in(status: str) -> str:
    return f"cast(sum(CASE WHEN d.old_status = '{status}' THEN d.mins ELSE 0 END) AS bigint) AS minutes_in_{status.lower()}"


TOTAL_MINUTES = "date_diff('minute', o.created_at, o.updated_at)"

STATUS_SQL = f"""
WITH d AS (
  SELECT order_id, old_status, status_changed_at, row_number() OVER w AS seq, count(*) OVER (PARTITION BY order_id) AS changes,
    date_diff('minute', lag(status_changed_at) OVER w, status_changed_at) AS mins
  FROM order_history WINDOW w AS (PARTITION BY order_id ORDER BY status_changed_at, new_status))
SELECT o.order_id, o.order_date, o.customer_id, c.customer_name, o.restaurant_id, r.restaurant_name, r.cuisine_type, cast(o.total_amount AS double) AS total_amount,
  o.order_status AS current_status, o.order_status AS initial_status, o.updated_at AS status_updated_at, max(d.changes) AS total_status_changes,
  {", ".join(_minutes_in(s) for s in m.TIMED_STATUSES)},
  {TOTAL_MINUTES} AS total_processing_time_mins, min(d.status_changed_at) AS first_status_change_time,
  date_diff('minute', o.created_at, min(d.status_changed_at)) AS minutes_to_first_status_change,
  CASE WHEN max(d.changes) >= 5 THEN 'HIGH_VELOCITY' WHEN max(d.changes) >= 3 THEN 'NORMAL_VELOCITY' ELSE 'LOW_VELOCITY' END AS status_change_velocity,
  CASE WHEN o.order_status = 'CANCELLED' AND max(d.seq) = 1 THEN 'CANCELLED_IMMEDIATELY' WHEN o.order_status = 'CANCELLED' AND max(d.seq) <= 3 THEN 'CANCELLED_EARLY'
       WHEN o.order_status = 'CANCELLED' THEN 'CANCELLED_LATE' ELSE 'NOT_CANCELLED' END AS cancellation_stage,
  CASE WHEN o.order_status = 'COMPLETED' AND {TOTAL_MINUTES} <= 60 THEN 'FAST_COMPLETION' WHEN o.order_status = 'COMPLETED' THEN 'NORMAL_COMPLETION'
       WHEN o.order_status = 'CANCELLED' THEN 'FAILED' ELSE 'IN_PROGRESS' END AS order_outcome
FROM fact_order o LEFT JOIN dim_restaurant r ON o.restaurant_id = r.restaurant_id LEFT JOIN dim_customer c ON o.customer_id = c.customer_id
LEFT JOIN d ON o.order_id = d.order_id
GROUP BY o.order_id, o.order_date, o.customer_id, c.customer_name, o.restaurant_id, r.restaurant_name, r.cuisine_type, o.total_amount, o.order_status, o.updated_at, o.created_at"""

SUMMARY_SQL = f"""
SELECT o.order_id, o.order_date, cast(o.order_date AS date) AS order_date_key, cast(o.total_amount AS double) AS total_amount, o.order_status AS current_status,
  o.order_status AS initial_status, o.payment_method, o.updated_at AS status_updated_at, o.customer_id, c.customer_name, c.gender AS customer_gender, c.login_by_using,
  date_diff('year', c.dob, o.order_date) AS customer_age_at_order, o.restaurant_id, r.restaurant_name, r.cuisine_type, cast(r.pricing_for_two AS double) AS restaurant_pricing,
  r.locality AS restaurant_locality, l.city, l.state, l.city_tier, l.zip_code, fd.delivery_id, fd.delivery_agent_id, fd.delivery_date, fd.delivery_status,
  {ESTIMATE} AS estimated_delivery_time_mins, {ACTUAL} AS actual_delivery_time_mins,
  year(o.order_date) AS year, quarter(o.order_date) AS quarter, month(o.order_date) AS month, week(o.order_date) AS week, isodow(o.order_date) AS day_of_week,
  left(dayname(o.order_date), 3) AS day_name, hour(o.order_date) AS order_hour, {hour_label('o.order_date')} AS time_of_day, {weekend('o.order_date')} AS day_type,
  {VALUE_SEGMENT} AS order_value_segment,
  row_number() OVER (PARTITION BY o.customer_id ORDER BY o.order_date, o.order_id, fd.delivery_id NULLS FIRST) AS customer_order_number,
  row_number() OVER (PARTITION BY o.restaurant_id ORDER BY o.order_date, o.order_id, fd.delivery_id NULLS FIRST) AS restaurant_order_number,
  cast(CASE WHEN o.order_status = 'COMPLETED' THEN 1 ELSE 0 END AS bigint) AS is_completed, cast(CASE WHEN o.order_status = 'CANCELLED' THEN 1 ELSE 0 END AS bigint) AS is_cancelled,
  cast(CASE WHEN o.order_status = 'PENDING' THEN 1 ELSE 0 END AS bigint) AS is_pending,
  cast(CASE WHEN fd.delivery_status = 'DELIVERED' AND {ACTUAL} <= {ESTIMATE} THEN 1 ELSE 0 END AS bigint) AS is_on_time_delivery,
  cast(CASE WHEN fd.delivery_status = 'DELIVERED' THEN 1 ELSE 0 END AS bigint) AS is_delivered,
  {TOTAL_MINUTES} AS order_processing_time_mins
FROM fact_order o LEFT JOIN dim_customer c ON o.customer_id = c.customer_id LEFT JOIN dim_restaurant r ON o.restaurant_id = r.restaurant_id
LEFT JOIN dim_location l ON r.location_id = l.location_id LEFT JOIN fact_delivery fd ON o.order_id = fd.order_id"""

TIME_SQL = f"""
SELECT o.order_id, o.order_date, cast(o.order_date AS date) AS order_date_key, o.customer_id, o.restaurant_id, cast(o.total_amount AS double) AS total_amount,
  o.order_status AS current_status, o.payment_method, year(o.order_date) AS year, quarter(o.order_date) AS quarter, month(o.order_date) AS month, week(o.order_date) AS week,
  dayofyear(o.order_date) AS day_of_year, isodow(o.order_date) AS day_of_week, day(o.order_date) AS day_of_the_month, left(dayname(o.order_date), 3) AS day_name,
  hour(o.order_date) AS order_hour, minute(o.order_date) AS order_minute, {hour_label('o.order_date')} AS time_of_day, {weekend('o.order_date')} AS day_type,
  CASE WHEN isodow(o.order_date) = 1 THEN 'MONDAY' WHEN isodow(o.order_date) = 5 THEN 'FRIDAY' WHEN isodow(o.order_date) IN (6, 7) THEN 'WEEKEND' ELSE 'MID_WEEK' END AS day_category,
  CASE WHEN hour(o.order_date) BETWEEN 7 AND 10 THEN 'BREAKFAST' WHEN hour(o.order_date) BETWEEN 11 AND 14 THEN 'LUNCH' WHEN hour(o.order_date) BETWEEN 16 AND 18 THEN 'SNACK'
       WHEN hour(o.order_date) BETWEEN 19 AND 22 THEN 'DINNER' ELSE 'LATE_NIGHT' END AS meal_time,
  CASE WHEN hour(o.order_date) BETWEEN 12 AND 14 THEN 'LUNCH_PEAK' WHEN hour(o.order_date) BETWEEN 19 AND 21 THEN 'DINNER_PEAK' ELSE 'OFF_PEAK' END AS peak_indicator,
  r.restaurant_name, r.cuisine_type, l.city, l.state,
  count(o.order_id) OVER (PARTITION BY cast(o.order_date AS date), hour(o.order_date)) AS orders_in_same_hour,
  count(o.order_id) OVER (PARTITION BY o.restaurant_id, cast(o.order_date AS date), hour(o.order_date)) AS restaurant_orders_in_same_hour,
  count(o.order_id) OVER (PARTITION BY o.customer_id, cast(o.order_date AS date)) AS customer_orders_same_day,
  cast(sum(o.total_amount) OVER (PARTITION BY hour(o.order_date)) AS double) / count(*) OVER (PARTITION BY hour(o.order_date)) AS avg_order_value_for_hour,
  cast(sum(o.total_amount) OVER (PARTITION BY isodow(o.order_date)) AS double) / count(*) OVER (PARTITION BY isodow(o.order_date)) AS avg_order_value_for_day,
  CASE WHEN month(o.order_date) IN (12, 1, 2) THEN 'WINTER' WHEN month(o.order_date) IN (3, 4, 5) THEN 'SPRING' WHEN month(o.order_date) IN (6, 7, 8) THEN 'SUMMER' ELSE 'FALL' END AS season,
  CASE WHEN day(o.order_date) <= 10 THEN 'EARLY_MONTH' WHEN day(o.order_date) <= 20 THEN 'MID_MONTH' ELSE 'END_MONTH' END AS month_period
FROM event_order o LEFT JOIN dim_restaurant r ON o.restaurant_id = r.restaurant_id LEFT JOIN dim_location l ON r.location_id = l.location_id"""


@case("m9_order_cohort", COHORT_SQL)
def _(t):
    return m.order_cohort(t)


@case("m10_customer_journey", JOURNEY_SQL)
def _(t):
    return m.customer_journey(t, ORDER_AS_OF)


@case("m11_order_fulfillment", FULFILLMENT_SQL)
def _(t):
    return m.order_fulfillment(t)


@case("m12_order_payment", PAYMENT_SQL)
def _(t):
    return m.order_payment(t)


@case("m13_restaurant_daily", DAILY_SQL)
def _(t):
    return m.restaurant_daily(t)


@case("m14_order_status_analysis", STATUS_SQL)
def _(t):
    return m.order_status_analysis(t)


@case("m15_order_summary", SUMMARY_SQL)
def _(t):
    return m.order_summary(t)


@case("m16_order_time_analysis", TIME_SQL)
def _(t):
    return m.order_time_analysis(t.using(fact_order="event_order"))


@case("m10_customer_journey_events", JOURNEY_SQL.replace("fact_order", "event_order").replace(ORDER_AS_OF, EVENT_AS_OF))
def _(t):
    return m.customer_journey(t.using(fact_order="event_order"), EVENT_AS_OF)


@case("m12_order_payment_events", PAYMENT_SQL.replace("fact_order", "event_order"))
def _(t):
    return m.order_payment(t.using(fact_order="event_order"))
