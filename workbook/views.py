"""The entity tables as SQL, for the check queries only."""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {
    "fact_order_item": """
SELECT concat(cast(l_orderkey AS varchar), '-', cast(l_linenumber AS varchar)) AS order_item_id,
  cast(l_orderkey AS varchar) AS order_id, l_partkey AS menu_id, l_suppkey AS restaurant_id,
  cast(l_quantity AS decimal(10,2)) AS quantity, cast(l_extendedprice AS decimal(18,2)) AS subtotal,
  cast(l_shipdate AS date) AS ship_date, l_returnflag, l_linestatus, l_orderkey, l_linenumber
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate, l_discount, l_tax, l_returnflag, l_linestatus) AS rn
      FROM lineitem) t WHERE rn = 1""",
    "fact_order": """
SELECT cast(o_orderkey AS varchar) AS order_id, cast(o_custkey AS varchar) AS customer_id, i.restaurant_id,
  o_orderdate AS order_date, cast(o_totalprice AS decimal(18,2)) AS total_amount,
  CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'PENDING' ELSE 'CANCELLED' END AS order_status,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'UPI' WHEN '2-HIGH' THEN 'CREDIT_CARD' WHEN '3-MEDIUM' THEN 'CASH'
       WHEN '4-NOT SPECIFIED' THEN 'WALLET' ELSE 'NET_BANKING' END AS payment_method,
  o_orderdate AS created_at, o_orderdate + to_minutes(o_orderkey % 120) AS updated_at, 'ACTIVE' AS status
FROM orders LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS restaurant_id FROM lineitem GROUP BY l_orderkey) i
  ON o_orderkey = i.l_orderkey""",
    "dim_customer": """
SELECT cast(c_custkey AS varchar) AS customer_id, c_name AS customer_name,
  concat('9', lpad(cast(c_custkey AS varchar), 9, '0')) AS mobile,
  concat('c', cast(c_custkey AS varchar), '@mail.test') AS email, c_mktsegment AS login_by_using,
  CASE c_custkey % 3 WHEN 0 THEN 'MALE' WHEN 1 THEN 'FEMALE' ELSE 'OTHER' END AS gender,
  DATE '1960-01-01' + cast(c_custkey % 16000 AS integer) AS dob,
  concat('{"segment":"', c_mktsegment, '"}') AS preferences, c_nationkey AS location_id, 'ACTIVE' AS status
FROM customer""",
    "dim_restaurant": """
SELECT s_suppkey AS restaurant_id, s_name AS restaurant_name,
  CASE s_suppkey % 5 WHEN 0 THEN 'NORTH INDIAN' WHEN 1 THEN 'SOUTH INDIAN' WHEN 2 THEN 'CHINESE' WHEN 3 THEN 'ITALIAN' ELSE 'CAFE' END AS cuisine_type,
  cast(300 + (s_suppkey % 9) * 100 AS decimal(10,2)) AS pricing_for_two,
  concat('AREA_', cast(s_suppkey % 7 AS varchar)) AS locality,
  CASE s_suppkey % 4 WHEN 0 THEN 'CLOSED' ELSE 'OPEN' END AS open_status, s_nationkey AS location_id, 'ACTIVE' AS status
FROM supplier""",
    "dim_menu": """
SELECT p_partkey AS menu_id, p_partkey % (SELECT count(*) FROM supplier) AS restaurant_id, p_name AS item_name,
  p_type AS category, cast(p_retailprice AS decimal(10,2)) AS price, p_brand AS item_type,
  CASE p_size % 10 WHEN 0 THEN 'UNAVAILABLE' ELSE 'AVAILABLE' END AS availability, 'ACTIVE' AS status
FROM part""",
    "dim_location": """
SELECT n_nationkey AS location_id, n_name AS city, r_name AS state,
  CASE WHEN r_regionkey <= 1 THEN 'TIER1' WHEN r_regionkey = 2 THEN 'TIER2' ELSE 'TIER3' END AS city_tier,
  cast(100000 + n_nationkey * 37 AS varchar) AS zip_code
FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "dim_delivery_agent": """
SELECT s_suppkey AS delivery_agent_id, s_name AS delivery_agent_name,
  concat('8', lpad(cast(s_suppkey AS varchar), 9, '0')) AS phone,
  CASE s_suppkey % 4 WHEN 0 THEN 'BIKE' WHEN 1 THEN 'SCOOTER' WHEN 2 THEN 'BICYCLE' ELSE 'CAR' END AS vehicle_type,
  CASE s_suppkey % 2 WHEN 0 THEN 'MALE' ELSE 'FEMALE' END AS gender,
  cast((35 + s_suppkey % 16) / 10.0 AS decimal(2,1)) AS rating, s_nationkey AS location_id, 'ACTIVE' AS status
FROM supplier""",
    "dim_customer_address": """
SELECT c_custkey AS customer_address_id, cast(c_custkey AS varchar) AS customer_id, n_name AS city,
  concat('AREA_', cast(c_custkey % 7 AS varchar)) AS locality, cast(100000 + c_nationkey * 37 AS varchar) AS zipcode,
  CASE c_custkey % 3 WHEN 0 THEN 'HOME' WHEN 1 THEN 'WORK' ELSE 'OTHER' END AS address_type, 'ACTIVE' AS status
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "fact_delivery": """
SELECT order_item_id AS delivery_id, order_id, restaurant_id AS delivery_agent_id,
  CASE l_returnflag WHEN 'A' THEN 'DELIVERED' WHEN 'R' THEN 'FAILED' ELSE 'IN_TRANSIT' END AS delivery_status,
  concat(cast(cast(quantity AS integer) AS varchar), ' mins') AS estimated_time, o_custkey AS customer_address_id,
  cast(ship_date AS timestamp) + to_minutes((l_orderkey * 7 + l_linenumber * 31) % 1440) AS delivery_date,
  cast(ship_date AS timestamp) + to_minutes((l_orderkey * 7 + l_linenumber * 31) % 1440) AS created_at,
  cast(ship_date AS timestamp) + to_minutes((l_orderkey * 7 + l_linenumber * 31) % 1440)
    + to_minutes((l_orderkey * 13 + l_linenumber * 17) % 60) AS updated_at, 'ACTIVE' AS status
FROM fact_order_item LEFT JOIN orders ON l_orderkey = o_orderkey""",
    "event_order": """
SELECT cast(event_id AS varchar) AS order_id, cast(user_id AS varchar) AS customer_id, user_id % 10 AS restaurant_id,
  ts AS order_date, cast(value AS decimal(18,2)) AS total_amount,
  CASE event_id % 3 WHEN 0 THEN 'COMPLETED' WHEN 1 THEN 'PENDING' ELSE 'CANCELLED' END AS order_status,
  CASE event_id % 5 WHEN 0 THEN 'UPI' WHEN 1 THEN 'CREDIT_CARD' WHEN 2 THEN 'CASH' WHEN 3 THEN 'WALLET' ELSE 'NET_BANKING' END AS payment_method,
  ts AS created_at, ts + to_minutes(event_id % 120) AS updated_at, 'ACTIVE' AS status
FROM events WHERE event_type = 'purchase'""",
    "status_history": """
SELECT entity_id, old_status, new_status, status_changed_at FROM (
  SELECT entity_id, lag(status) OVER (PARTITION BY entity_id ORDER BY ts, event_id) AS old_status, status AS new_status, ts AS status_changed_at
  FROM (SELECT user_id AS entity_id, ts, event_id, CASE event_type WHEN 'click' THEN 'PENDING' WHEN 'view' THEN 'CONFIRMED'
          WHEN 'signup' THEN 'PREPARING' WHEN 'purchase' THEN 'READY' WHEN 'error' THEN 'OUT_FOR_DELIVERY' END AS status FROM events) e) t
WHERE old_status IS NULL OR old_status <> new_status""",
    "order_history": """
SELECT cast(entity_id AS varchar) AS order_id, old_status, new_status, status_changed_at FROM status_history""",
    "delivery_history": """
SELECT concat(cast(entity_id AS varchar), '-1') AS delivery_id, old_status, new_status, status_changed_at FROM status_history""",
    "ingest_run": """
SELECT event_id AS ingest_run_id, concat('PIPELINE_', cast(user_id % 5 AS varchar)) AS pipeline_name,
  CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS run_status, 100 + event_id % 50 AS source_row_count,
  100 + event_id % 50 - event_id % 7 AS valid_row_count, event_id % 7 AS invalid_row_count,
  cast(value AS decimal(18,2)) AS execution_duration_sec, ts AS executed_at FROM events""",
    "dead_letter": """
SELECT event_id AS dlq_id, concat('PIPELINE_', cast(user_id % 5 AS varchar)) AS pipeline_name,
  CASE event_id % 3 WHEN 0 THEN 'TECHNICAL' WHEN 1 THEN 'TRANSFORMATION' ELSE 'REFERENTIAL' END AS error_type, props AS record_data,
  CASE (event_id // 7) % 4 WHEN 0 THEN 'PENDING' WHEN 1 THEN 'RETRYING' WHEN 2 THEN 'RESOLVED' ELSE 'ABANDONED' END AS processing_status,
  event_id % 4 AS retry_count, CASE WHEN event_id % 4 > 0 THEN ts + to_minutes((event_id % 4) * 10) END AS last_retry_at, ts AS created_at
FROM events WHERE event_type = 'error'""",
    "alerts": """
SELECT event_id AS alert_id, concat('PIPELINE_', cast(user_id % 5 AS varchar)) AS pipeline_name,
  CASE event_id % 2 WHEN 0 THEN 'SLA_BREACH' ELSE 'DEGRADATION' END AS alert_type, CASE WHEN event_id % 3 = 0 THEN 'CRITICAL' ELSE 'WARNING' END AS severity,
  CASE event_id % 2 WHEN 0 THEN 'QUALITY' ELSE 'PERFORMANCE' END AS metric_name, cast(value AS decimal(10,2)) AS actual_value,
  cast(95 AS decimal(10,2)) AS threshold_value, concat('Event ', cast(event_id AS varchar)) AS alert_message,
  CASE (event_id // 7) % 4 WHEN 0 THEN 'RESOLVED' ELSE 'OPEN' END AS alert_status, ts AS detected_at
FROM events WHERE event_type = 'error'""",
    "order_item_raw": """
SELECT concat(cast(l_orderkey AS varchar), '-', cast(l_linenumber AS varchar)) AS order_item_id,
  CASE WHEN l_partkey % 50 = 0 THEN '' ELSE cast(l_orderkey AS varchar) END AS order_id,
  CASE WHEN l_suppkey % 33 = 0 THEN 'NULL' ELSE cast(l_partkey AS varchar) END AS menu_id,
  CASE WHEN l_partkey % 97 = 0 THEN '0' ELSE cast(cast(l_quantity AS integer) AS varchar) END AS quantity,
  cast(cast(l_extendedprice AS decimal(18,2)) AS varchar) AS price,
  CASE WHEN l_partkey % 41 = 0 THEN cast(cast(cast(l_extendedprice AS decimal(18,2)) * cast(l_quantity AS integer) + 1 AS decimal(18,2)) AS varchar)
       ELSE cast(cast(cast(l_extendedprice AS decimal(18,2)) * cast(l_quantity AS integer) AS decimal(18,2)) AS varchar) END AS subtotal,
  CASE WHEN l_partkey % 61 = 0 THEN 'unknown' ELSE cast(cast(l_shipdate AS date) AS varchar) END AS order_timestamp,
  l_partkey AS src_partkey, l_suppkey AS src_suppkey FROM lineitem""",
    "landed_order": """
SELECT cast(event_id AS varchar) AS order_id, cast(user_id AS varchar) AS customer_id, cast(value AS decimal(18,2)) AS total_amount,
  CASE event_id % 3 WHEN 0 THEN 'COMPLETED' WHEN 1 THEN 'PENDING' ELSE 'CANCELLED' END AS order_status, event_id AS kafka_offset,
  ts AS kafka_timestamp, ts + to_seconds(event_id % 400) AS ingested_at, event_id % 4 <> 0 AS processed_to_gold
FROM events WHERE event_type = 'purchase'""",
    "gold_order": """
SELECT order_id, customer_id, total_amount, order_status, ingested_at + to_seconds(kafka_offset % 90) AS created_at,
  concat('STREAM_', cast(kafka_offset % 20 AS varchar)) AS batch_id FROM landed_order WHERE processed_to_gold""",
    "landed_item": """
SELECT order_item_id, order_id, cast(ship_date AS timestamp) + to_seconds(l_orderkey % 300) AS ingested_at FROM fact_order_item""",
    "landed_delivery": """
SELECT delivery_id, order_id, delivery_date AS ingested_at FROM fact_delivery""",
}


def with_views(sql: str) -> str:
    """Put the definitions of the entity tables a statement names in front of it."""
    names: list[str] = []

    def visit(text: str) -> None:
        for name in VIEWS:
            if name not in names and re.search(rf"\b{name}\b", text):
                visit(VIEWS[name])
                if name not in names:
                    names.append(name)

    visit(sql)
    if not names:
        return sql.strip()
    ordered = [n for n in VIEWS if n in names]
    body = sql.strip()
    definitions = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in ordered)
    keyword = "WITH RECURSIVE" if body.upper().startswith("WITH RECURSIVE") else "WITH"
    if body.upper().startswith(keyword):
        return f"{keyword} {definitions},\n{body[len(keyword):].strip()}"
    return f"WITH {definitions}\n{body}"
