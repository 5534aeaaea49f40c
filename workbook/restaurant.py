"""Restaurant marts and their checks."""

from silverlode.plans import restaurant_marts as m
from workbook.core import case
from workbook.orders import hour_label, weekend

CUISINE_SQL = """
SELECT r.cuisine_type, l.city, l.state, l.city_tier, count(DISTINCT r.restaurant_id) AS restaurant_count, count(DISTINCT o.order_id) AS total_orders,
  cast(sum(o.total_amount) AS double) AS total_revenue, cast(sum(o.total_amount) AS double) / nullif(count(o.total_amount), 0) AS avg_order_value,
  cast(count(DISTINCT o.order_id) AS double) / count(DISTINCT r.restaurant_id) AS avg_orders_per_restaurant,
  cast(sum(o.total_amount) AS double) / count(DISTINCT r.restaurant_id) AS avg_revenue_per_restaurant,
  count(DISTINCT o.customer_id) AS unique_customers, cast(sum(r.pricing_for_two) AS double) / count(r.pricing_for_two) AS avg_pricing_for_two,
  cast(sum(o.total_amount) AS double) / cast(sum(sum(o.total_amount)) OVER (PARTITION BY l.city) AS double) * 100 AS city_market_share_pct
FROM dim_restaurant r LEFT JOIN fact_order o ON r.restaurant_id = o.restaurant_id LEFT JOIN dim_location l ON r.location_id = l.location_id
GROUP BY r.cuisine_type, l.city, l.state, l.city_tier"""

MENU_SQL = """
WITH mo AS (
  SELECT m.menu_id, m.restaurant_id, m.item_name, m.category, m.price, m.item_type, m.availability, count(DISTINCT o.order_id) AS estimated_orders,
    cast(sum(o.total_amount) AS double) / nullif(count(DISTINCT o.order_id), 0) AS avg_order_with_item
  FROM dim_menu m LEFT JOIN fact_order o ON m.restaurant_id = o.restaurant_id GROUP BY ALL),
items AS (SELECT menu_id, count(DISTINCT order_id) AS n FROM fact_order_item GROUP BY menu_id),
priced AS (
  SELECT mo.*, coalesce(items.n, 0) AS item_orders,
    cast(sum(price) OVER (PARTITION BY restaurant_id, category) AS double) / count(price) OVER (PARTITION BY restaurant_id, category) AS avg_category_price
  FROM mo LEFT JOIN items ON mo.menu_id = items.menu_id)
SELECT p.menu_id, p.restaurant_id, r.restaurant_name, p.item_name, p.category, cast(p.price AS double) AS price, p.item_type, p.availability, p.estimated_orders, p.item_orders,
  p.avg_order_with_item, p.avg_category_price, cast(p.price AS double) / nullif(p.avg_category_price, 0) * 100 AS price_index,
  row_number() OVER (PARTITION BY p.restaurant_id ORDER BY p.estimated_orders DESC, p.menu_id) AS popularity_rank,
  row_number() OVER (PARTITION BY p.restaurant_id ORDER BY p.price * p.estimated_orders DESC, p.menu_id) AS revenue_rank
FROM priced p LEFT JOIN dim_restaurant r ON p.restaurant_id = r.restaurant_id"""

PERFORMANCE_SQL = """
WITH a AS (
  SELECT r.restaurant_id, r.restaurant_name, r.cuisine_type, cast(r.pricing_for_two AS double) AS pricing_for_two, r.locality, l.city, l.state, l.city_tier, r.open_status,
    count(DISTINCT o.order_id) AS total_orders, count(DISTINCT o.customer_id) AS unique_customers, cast(sum(o.total_amount) AS double) AS total_revenue,
    cast(sum(o.total_amount) AS double) / nullif(count(o.total_amount), 0) AS avg_order_value,
    CASE WHEN count(DISTINCT o.customer_id) = 0 THEN 0.0 ELSE cast(count(DISTINCT o.order_id) AS double) / count(DISTINCT o.customer_id) END AS orders_per_customer,
    cast(sum(CASE WHEN o.order_status = 'COMPLETED' THEN 1 ELSE 0 END) AS bigint) AS completed_orders,
    cast(sum(CASE WHEN o.order_status = 'CANCELLED' THEN 1 ELSE 0 END) AS bigint) AS cancelled_orders,
    cast(sum(CASE WHEN o.order_status = 'CANCELLED' THEN 1 ELSE 0 END) AS double) / count(*) * 100 AS cancellation_rate,
    min(o.order_date) AS first_order_date, max(o.order_date) AS last_order_date, date_diff('day', min(o.order_date), max(o.order_date)) AS operational_days,
    cast(count(DISTINCT o.order_id) AS double) / nullif(count(DISTINCT cast(o.order_date AS date)), 0) AS avg_orders_per_day,
    cast(sum(o.total_amount) AS double) / nullif(count(DISTINCT cast(o.order_date AS date)), 0) AS avg_revenue_per_day
  FROM dim_restaurant r LEFT JOIN fact_order o ON r.restaurant_id = o.restaurant_id LEFT JOIN dim_location l ON r.location_id = l.location_id GROUP BY ALL)
SELECT *, CASE WHEN total_orders >= 500 AND avg_order_value >= 500 THEN 'PLATINUM' WHEN total_orders >= 200 AND avg_order_value >= 300 THEN 'GOLD'
  WHEN total_orders >= 50 THEN 'SILVER' ELSE 'BRONZE' END AS restaurant_tier FROM a"""

SLOT_SQL = f"""
SELECT r.restaurant_id, r.restaurant_name, r.cuisine_type, left(dayname(o.order_date), 3) AS day_name, isodow(o.order_date) AS day_of_week, {weekend('o.order_date')} AS day_type,
  hour(o.order_date) AS order_hour, {hour_label('o.order_date')} AS time_of_day, count(DISTINCT o.order_id) AS total_orders, cast(sum(o.total_amount) AS double) AS total_revenue,
  cast(sum(o.total_amount) AS double) / count(o.total_amount) AS avg_order_value, count(DISTINCT o.customer_id) AS unique_customers,
  cast(sum(CASE WHEN o.order_status = 'COMPLETED' THEN 1 ELSE 0 END) AS bigint) AS completed_orders,
  cast(sum(CASE WHEN o.order_status = 'COMPLETED' THEN 1 ELSE 0 END) AS double) / count(*) * 100 AS completion_rate,
  row_number() OVER (PARTITION BY r.restaurant_id ORDER BY count(DISTINCT o.order_id) DESC, isodow(o.order_date), hour(o.order_date)) AS peak_time_rank
FROM dim_restaurant r JOIN event_order o ON r.restaurant_id = o.restaurant_id
GROUP BY r.restaurant_id, r.restaurant_name, r.cuisine_type, dayname(o.order_date), isodow(o.order_date), hour(o.order_date), {weekend('o.order_date')}, {hour_label('o.order_date')}"""


@case("m17_cuisine_performance", CUISINE_SQL)
def _(t):
    return m.cuisine_performance(t)


@case("m18_menu_performance", MENU_SQL)
def _(t):
    return m.menu_performance(t)


@case("m19_restaurant_performance", PERFORMANCE_SQL)
def _(t):
    return m.restaurant_performance(t)


@case("m20_restaurant_time_performance", SLOT_SQL)
def _(t):
    return m.restaurant_time_performance(t.using(fact_order="event_order"))
