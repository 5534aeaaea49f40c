"""Customer marts and their checks."""

from silverlode.plans import customer_marts as m
from workbook.core import ORDER_AS_OF, case

COHORT_SQL = """
WITH firsts AS (SELECT customer_id, date_trunc('month', min(order_date)) AS cohort_month FROM fact_order WHERE status = 'ACTIVE' GROUP BY customer_id),
cells AS (
  SELECT f.cohort_month, date_trunc('month', o.order_date) AS order_month,
    date_diff('month', f.cohort_month, date_trunc('month', o.order_date)) AS months_since_first_order,
    count(DISTINCT o.customer_id) AS active_customers, count(DISTINCT o.order_id) AS total_orders, sum(o.total_amount) AS total_revenue
  FROM firsts f JOIN fact_order o ON f.customer_id = o.customer_id WHERE o.status = 'ACTIVE' GROUP BY ALL)
SELECT cast(cohort_month AS date) AS cohort_month, cast(order_month AS date) AS order_month, months_since_first_order, active_customers,
  total_orders, cast(total_revenue AS double) AS total_revenue,
  round(cast(active_customers AS double) / first_value(active_customers) OVER (PARTITION BY cohort_month ORDER BY months_since_first_order) * 100, 2) AS retention_rate
FROM cells"""

SUMMARY_SQL = f"""
WITH co AS (
  SELECT c.customer_id, c.customer_name, c.gender, c.dob, date_diff('year', c.dob, DATE '{ORDER_AS_OF[:10]}') AS customer_age,
    c.login_by_using, c.preferences, o.order_id, o.order_date, o.total_amount, o.payment_method, o.order_status
  FROM dim_customer c LEFT JOIN fact_order o ON c.customer_id = o.customer_id AND o.status = 'ACTIVE' WHERE c.status = 'ACTIVE'),
modes AS (
  SELECT customer_id, payment_method FROM (
    SELECT customer_id, payment_method, row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, payment_method) AS rn
    FROM co WHERE payment_method IS NOT NULL GROUP BY customer_id, payment_method) x WHERE rn = 1),
metrics AS (
  SELECT customer_id, customer_name, gender, dob, customer_age, login_by_using, preferences, count(DISTINCT order_id) AS total_orders,
    cast(sum(total_amount) AS double) AS lifetime_value, cast(sum(total_amount) AS double) / count(total_amount) AS avg_order_value,
    min(order_date) AS first_order_date, max(order_date) AS last_order_date,
    date_diff('day', min(order_date), max(order_date)) AS customer_tenure_days,
    date_diff('day', max(order_date), TIMESTAMP '{ORDER_AS_OF}') AS days_since_last_order,
    count(DISTINCT date_trunc('month', order_date)) AS active_months, count(DISTINCT payment_method) AS payment_methods_used,
    cast(sum(CASE WHEN order_status = 'COMPLETED' THEN 1 ELSE 0 END) AS bigint) AS completed_orders,
    cast(sum(CASE WHEN order_status = 'CANCELLED' THEN 1 ELSE 0 END) AS bigint) AS cancelled_orders,
    cast(sum(CASE WHEN order_status = 'CANCELLED' THEN 1 ELSE 0 END) AS double) / count(*) * 100 AS cancellation_rate
  FROM co GROUP BY ALL)
SELECT m.customer_id, customer_name, gender, dob, customer_age, login_by_using, preferences, total_orders, lifetime_value, avg_order_value,
  first_order_date, last_order_date, customer_tenure_days, days_since_last_order, active_months,
  CASE WHEN active_months > 0 THEN cast(total_orders AS double) / active_months END AS orders_per_active_month,
  modes.payment_method AS preferred_payment_method, payment_methods_used, completed_orders, cancelled_orders, cancellation_rate,
  CASE WHEN total_orders >= 20 THEN 'VIP' WHEN total_orders >= 10 THEN 'LOYAL' WHEN total_orders >= 5 THEN 'REGULAR'
       WHEN total_orders >= 2 THEN 'REPEAT' ELSE 'NEW' END AS customer_segment,
  CASE WHEN days_since_last_order <= 30 THEN 'ACTIVE' WHEN days_since_last_order <= 90 THEN 'AT_RISK' ELSE 'CHURNED' END AS customer_status
FROM metrics m LEFT JOIN modes ON m.customer_id = modes.customer_id"""

PREFERENCES_SQL = """
SELECT c.customer_id, c.customer_name, r.restaurant_id, r.restaurant_name, r.cuisine_type, l.city, l.state,
  count(DISTINCT o.order_id) AS orders_from_restaurant, cast(sum(o.total_amount) AS double) AS total_spent,
  cast(sum(o.total_amount) AS double) / count(o.total_amount) AS avg_spend_per_order, max(o.order_date) AS last_order_date,
  row_number() OVER (PARTITION BY c.customer_id ORDER BY count(DISTINCT o.order_id) DESC, r.restaurant_id) AS restaurant_preference_rank
FROM dim_customer c JOIN fact_order o ON c.customer_id = o.customer_id JOIN dim_restaurant r ON o.restaurant_id = r.restaurant_id
LEFT JOIN dim_location l ON r.location_id = l.location_id
GROUP BY c.customer_id, c.customer_name, r.restaurant_id, r.restaurant_name, r.cuisine_type, l.city, l.state QUALIFY restaurant_preference_rank <= 10"""

PATTERNS_SQL = """
SELECT o.customer_id, c.customer_name, left(dayname(o.order_date), 3) AS day_name, isodow(o.order_date) AS day_of_week,
  hour(o.order_date) AS order_hour,
  CASE WHEN hour(o.order_date) BETWEEN 6 AND 11 THEN 'MORNING' WHEN hour(o.order_date) BETWEEN 12 AND 16 THEN 'AFTERNOON'
       WHEN hour(o.order_date) BETWEEN 17 AND 21 THEN 'EVENING' ELSE 'NIGHT' END AS time_of_day,
  CASE WHEN isodow(o.order_date) IN (6, 7) THEN 'WEEKEND' ELSE 'WEEKDAY' END AS day_type,
  count(DISTINCT o.order_id) AS orders_by_day, cast(sum(o.total_amount) AS double) AS revenue_by_day
FROM event_order o JOIN dim_customer c ON o.customer_id = c.customer_id GROUP BY ALL"""


@case("m1_customer_cohort", COHORT_SQL)
def _(t):
    return m.customer_cohort(t)


@case("m2_customer_order_summary", SUMMARY_SQL)
def _(t):
    return m.customer_order_summary(t, ORDER_AS_OF)


@case("m3_customer_restaurant_preferences", PREFERENCES_SQL)
def _(t):
    return m.customer_restaurant_preferences(t)


@case("m4_customer_time_patterns", PATTERNS_SQL)
def _(t):
    return m.customer_time_patterns(t.using(fact_order="event_order"))
