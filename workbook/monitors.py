"""Stream monitors over landing and Gold tables, with their checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from silverlode.streaming import monitors as m
from workbook.core import EVENT_AS_OF, case
from workbook.shapes import COMPLETENESS

AS_OF = f"TIMESTAMP '{EVENT_AS_OF}'"
# The whole event table lies within the last 31 days.
MONTH = 31 * 24
SINCE = f"{AS_OF} - INTERVAL '{MONTH}' HOUR"


@case("t1_throughput", f"SELECT date_trunc('minute', ingested_at) AS window_start, count(*) AS records, count(DISTINCT order_id) AS unique_orders FROM landed_order WHERE ingested_at >= {SINCE} GROUP BY 1")
def _(t):
    return m.throughput(t["landed_order"], EVENT_AS_OF, MONTH)


@case(
    "t2_business_metrics",
    f"""SELECT date_trunc('hour', created_at) AS window_start, count(DISTINCT order_id) AS total_orders, cast(sum(total_amount) AS double) AS total_revenue, cast(sum(total_amount) AS double) / count(*) AS avg_order_value,
      count(DISTINCT customer_id) AS unique_customers FROM gold_order WHERE created_at >= {SINCE} GROUP BY 1""",
)
def _(t):
    return m.business_metrics(t["gold_order"], EVENT_AS_OF, MONTH)


@case("t3_orders_per_minute", f"SELECT date_trunc('minute', created_at) AS window_start, count(*) AS order_count, cast(sum(total_amount) AS double) AS revenue FROM gold_order WHERE created_at >= {SINCE} GROUP BY 1")
def _(t):
    return m.orders_per_minute(t["gold_order"], EVENT_AS_OF, MONTH)


def _latency(a, b):
    d = f"date_diff('second', {a}, {b})"
    return f"cast(sum({d}) AS double) / count(*) AS avg_latency_sec, min({d}) AS min_latency_sec, max({d}) AS max_latency_sec, count(*) AS record_count"


@case(
    "t4_latency",
    f"""SELECT 'Event → Landing' AS stage, {_latency('kafka_timestamp', 'ingested_at')} FROM landed_order WHERE ingested_at >= {SINCE}
      UNION ALL SELECT 'Landing → Gold', {_latency('l.ingested_at', 'g.created_at')} FROM landed_order l JOIN gold_order g ON l.order_id = g.order_id WHERE l.ingested_at >= {SINCE}""",
)
def _(t):
    return m.latency(t["landed_order"], t["gold_order"], "order_id", EVENT_AS_OF, MONTH)


def pending(t):
    return t["landed_order"].where("not processed_to_gold")


@case(
    "t5_flow",
    """SELECT *, round(cast(gold_count AS double) / nullif(landed_count, 0) * 100, 2) AS processing_pct, landed_count - gold_count AS not_processed FROM (
      SELECT 'Orders' AS entity, (SELECT count(*) FROM landed_order) AS landed_count, (SELECT count(*) FROM gold_order) AS gold_count, (SELECT count(*) FROM landed_order WHERE NOT processed_to_gold) AS pending_count
      UNION ALL SELECT 'Order Items', (SELECT count(*) FROM lineitem), (SELECT count(*) FROM fact_order_item), (SELECT count(*) FROM lineitem WHERE l_linestatus = 'O')
      UNION ALL SELECT 'Deliveries', (SELECT count(*) FROM landed_delivery), (SELECT count(*) FROM fact_delivery WHERE delivery_status = 'DELIVERED'), (SELECT count(*) FROM fact_delivery WHERE delivery_status = 'IN_TRANSIT')) x""",
)
def _(t):
    state = F.col("delivery_status")
    return m.flow(
        {
            "Orders": (t["landed_order"], t["gold_order"], pending(t)),
            "Order Items": (t["lineitem"], t["fact_order_item"], t["lineitem"].where("l_linestatus = 'O'")),
            "Deliveries": (t["landed_delivery"], t["fact_delivery"].where(state == "DELIVERED"), t["fact_delivery"].where(state == "IN_TRANSIT")),
        }
    )


@case(
    "t6_health",
    f"""SELECT 'Landing Tables' AS component, CASE WHEN count(*) > 0 THEN '✓ Active' ELSE '✗ No Data' END AS status, concat('Last ingested: ', strftime(max(ingested_at), '%Y-%m-%d %H:%M:%S')) AS details FROM landed_order
      UNION ALL SELECT 'Change Stream', CASE WHEN count(*) > 0 THEN '⚠ Pending Data' ELSE '✓ Up to Date' END, concat(count(*), ' rows') FROM landed_order WHERE NOT processed_to_gold
      UNION ALL SELECT 'Runs', CASE WHEN max(executed_at) >= {AS_OF} - INTERVAL '10' MINUTE THEN '✓ Running' ELSE '✗ Stopped' END, concat(count(*), ' runs') FROM ingest_run""",
)
def _(t):
    return m.pipeline_health(t["landed_order"], pending(t), t["ingest_run"], EVENT_AS_OF)


@case(
    "t7_run_status",
    f"""SELECT ingest_run_id, pipeline_name, executed_at, cast(execution_duration_sec AS double) AS execution_duration_sec, CASE run_status WHEN 'FAILED' THEN '✗ Failed' ELSE '✓ Success' END AS status
      FROM ingest_run WHERE executed_at >= {SINCE}""",
)
def _(t):
    return m.run_status(t["ingest_run"], EVENT_AS_OF, MONTH)


@case("t7_run_failures", f"SELECT 'Task Failures' AS error_type, count(*) AS error_count, max(executed_at) AS last_error FROM ingest_run WHERE run_status = 'FAILED' AND executed_at >= {AS_OF} - INTERVAL '24' HOUR")
def _(t):
    return m.run_failures(t["ingest_run"], EVENT_AS_OF)


@case("t8_backlog_alert", "SELECT CASE WHEN count(*) > 1000 THEN '🚨 ALERT: Order stream backlog exceeds 1000 records' ELSE '✓ OK' END AS alert_status, count(*) AS current_backlog FROM landed_order WHERE NOT processed_to_gold")
def _(t):
    return m.backlog_alert(pending(t))


@case("t8_idle_alert", f"SELECT CASE WHEN max(executed_at) < {AS_OF} - INTERVAL '10' MINUTE THEN '🚨 ALERT: Tasks not executed in last 10 minutes' ELSE '✓ OK' END AS alert_status, max(executed_at) AS last_execution FROM ingest_run")
def _(t):
    return m.idle_alert(t["ingest_run"], EVENT_AS_OF)


WAITED = "date_diff('minute', kafka_timestamp, ingested_at)"


@case("t8_latency_alert", f"SELECT CASE WHEN cast(sum({WAITED}) AS double) / count(*) > 5 THEN '🚨 ALERT: High latency detected' ELSE '✓ OK' END AS alert_status, cast(sum({WAITED}) AS double) / count(*) AS avg_latency_min FROM landed_order WHERE ingested_at >= {SINCE}")
def _(t):
    return m.latency_alert(t["landed_order"], EVENT_AS_OF, MONTH)


@case("t9_landing_orders", "SELECT 'Orders' AS entity, count(*) AS total_records, count(DISTINCT order_id) AS unique_orders, min(ingested_at) AS first_record, max(ingested_at) AS last_record, count(*) FILTER (processed_to_gold) AS processed_count FROM landed_order")
def _(t):
    return m.landing_summary(t["landed_order"], "Orders", {"unique_orders": "order_id"})


@case("t9_landing_items", "SELECT 'Order Items' AS entity, count(*) AS total_records, count(DISTINCT order_item_id) AS unique_items, count(DISTINCT order_id) AS unique_orders, min(ingested_at) AS first_record, max(ingested_at) AS last_record FROM landed_item")
def _(t):
    return m.landing_summary(t["landed_item"], "Order Items", {"unique_items": "order_item_id", "unique_orders": "order_id"})


@case("t9_landing_deliveries", "SELECT 'Deliveries' AS entity, count(*) AS total_records, count(DISTINCT delivery_id) AS unique_deliveries, min(ingested_at) AS first_record, max(ingested_at) AS last_record FROM landed_delivery")
def _(t):
    return m.landing_summary(t["landed_delivery"], "Deliveries", {"unique_deliveries": "delivery_id"})


@case("t10_gold_orders", "SELECT count(*) AS total_orders, count(DISTINCT order_id) AS unique_orders, count(DISTINCT customer_id) AS unique_customers, min(created_at) AS first_order, max(created_at) AS last_order FROM fact_order")
def _(t):
    return m.gold_order_summary(t["fact_order"])


@case("t10_gold_items", "SELECT count(*) AS total_items, count(DISTINCT order_id) AS unique_orders, cast(sum(quantity) AS double) AS total_quantity, cast(sum(subtotal) AS double) AS total_amount FROM fact_order_item")
def _(t):
    return m.gold_item_summary(t["fact_order_item"])


@case("t10_gold_deliveries", "SELECT count(*) AS total_deliveries, count(DISTINCT order_id) AS unique_orders FROM fact_delivery")
def _(t):
    return m.gold_delivery_summary(t["fact_delivery"])


@case("t10_order_states", "SELECT order_status AS current_status, count(*) AS row_count, cast(sum(total_amount) AS double) AS total_revenue FROM fact_order GROUP BY 1")
def _(t):
    return m.status_distribution(t["fact_order"], "order_status", "total_amount")


@case("t10_delivery_states", "SELECT delivery_status AS current_status, count(*) AS row_count FROM fact_delivery GROUP BY 1")
def _(t):
    return m.status_distribution(t["fact_delivery"], "delivery_status")


@case("t11_layer_counts", "SELECT 'LANDING' AS layer, count(DISTINCT order_id) AS key_count FROM landed_order UNION ALL SELECT 'GOLD', count(DISTINCT order_id) FROM gold_order")
def _(t):
    return m.layer_counts({"LANDING": t["landed_order"], "GOLD": t["gold_order"]}, "order_id")


@case("t12_completeness", f"SELECT * FROM ({COMPLETENESS}) x ORDER BY order_id DESC, delivery_id NULLS FIRST LIMIT 10")
def _(t):
    return m.order_completeness(t["fact_order"], t["fact_order_item"], t["fact_delivery"])


@case("t13_latest_order_changes", "SELECT * FROM order_history ORDER BY status_changed_at DESC, order_id LIMIT 20")
def _(t):
    return m.latest_changes(t["order_history"], "order_id")


@case("t13_latest_delivery_changes", "SELECT * FROM delivery_history ORDER BY status_changed_at DESC, delivery_id LIMIT 20")
def _(t):
    return m.latest_changes(t["delivery_history"], "delivery_id")


@case("t14_orders_without_items", "SELECT o.order_id, cast(o.total_amount AS double) AS total_amount, count(i.order_item_id) AS item_count FROM fact_order o LEFT JOIN fact_order_item i ON o.order_id = i.order_id GROUP BY o.order_id, o.total_amount HAVING count(i.order_item_id) = 0")
def _(t):
    return m.orders_without_items(t["fact_order"], t["fact_order_item"])


@case("t14_orders_without_delivery", "SELECT o.order_id, o.order_status, o.created_at FROM fact_order o LEFT JOIN fact_delivery d ON o.order_id = d.order_id WHERE d.delivery_id IS NULL AND o.order_status NOT IN ('CANCELLED')")
def _(t):
    return m.orders_without_delivery(t["fact_order"], t["fact_delivery"])


@case("t15_active_deliveries", "SELECT delivery_status, count(*) AS delivery_count FROM fact_delivery WHERE delivery_status NOT IN ('DELIVERED', 'CANCELLED') GROUP BY 1")
def _(t):
    return m.active_deliveries(t["fact_delivery"])


@case("t16_batch_summary", "SELECT batch_id, max(created_at) AS last_created_at, count(*) AS row_count FROM gold_order GROUP BY 1")
def _(t):
    return m.batch_summary(t["gold_order"])
