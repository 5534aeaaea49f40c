"""Operational views and their dashboard queries, with their checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from silverlode.catalog import RETRIES
from silverlode.config import Sla
from silverlode.plans import operations as ops
from workbook.core import EVENT_AS_OF, case

AS_OF = f"TIMESTAMP '{EVENT_AS_OF}'"
SLAS = [
    Sla("PIPELINE_0", "LATENCY", "45", ">", "SECONDS", "WARNING"),
    Sla("PIPELINE_1", "LATENCY", "60", ">", "SECONDS", "CRITICAL"),
    Sla("PIPELINE_2", "QUALITY", "98", "<", "PERCENTAGE", "WARNING"),
    Sla("ALL", "AVAILABILITY", "80", "<", "PERCENTAGE", "CRITICAL"),
    Sla("ALL", "QUALITY", "95", "<", "PERCENTAGE", "WARNING"),
]
SLA_ROWS = ", ".join(f"('{s.pipeline_name}', '{s.metric_type}', cast({s.threshold} AS decimal(10,2)), '{s.operator}', '{s.unit}', '{s.severity}')" for s in SLAS)
QUALITY = "cast(valid_row_count AS double) / source_row_count * 100"

SLA_SQL = f"""
WITH sla_config(name, metric_type, threshold_value, op, unit, severity) AS (VALUES {SLA_ROWS}),
recent AS (
  SELECT pipeline_name, avg(cast(execution_duration_sec AS double)) AS latency, avg(CASE WHEN source_row_count > 0 THEN {QUALITY} ELSE 100 END) AS quality,
    cast(count(*) FILTER (run_status = 'SUCCESS') AS double) / count(*) * 100 AS availability FROM ingest_run WHERE executed_at >= {AS_OF} - INTERVAL '24' HOUR GROUP BY 1),
checks AS (
  SELECT r.pipeline_name, c.metric_type, c.threshold_value, c.op, c.unit, c.severity,
    CASE c.metric_type WHEN 'LATENCY' THEN latency WHEN 'QUALITY' THEN quality WHEN 'AVAILABILITY' THEN availability END AS actual
  FROM recent r JOIN sla_config c ON r.pipeline_name = c.name OR c.name = 'ALL'),
sla AS (
  SELECT pipeline_name, metric_type, round(actual, 6) AS actual_value, cast(threshold_value AS double) AS threshold_value,
    concat(op, ' ', cast(threshold_value AS varchar), ' ', unit) AS sla_threshold,
    CASE WHEN (op = '>' AND actual > threshold_value) OR (op = '<' AND actual < threshold_value) THEN '❌ BREACH' ELSE '✅ OK' END AS sla_status, severity,
    CASE WHEN (op = '>' AND actual > threshold_value) OR (op = '<' AND actual < threshold_value) THEN 'Exceeds SLA threshold' ELSE 'Within acceptable range' END AS status_message FROM checks)"""

DEGRADATION_SQL = f"""
WITH base AS (
  SELECT pipeline_name, avg(cast(execution_duration_sec AS double)) AS d, stddev(cast(execution_duration_sec AS double)) AS s, avg(cast(valid_row_count AS double) / nullif(source_row_count, 0)) AS q
  FROM ingest_run WHERE executed_at >= {AS_OF} - INTERVAL '7' DAY AND executed_at < {AS_OF} - INTERVAL '1' DAY GROUP BY 1),
recent AS (
  SELECT pipeline_name, avg(cast(execution_duration_sec AS double)) AS d, avg(cast(valid_row_count AS double) / nullif(source_row_count, 0)) AS q, count(*) AS n
  FROM ingest_run WHERE executed_at >= {AS_OF} - INTERVAL '24' HOUR GROUP BY 1),
degradation AS (
  SELECT r.pipeline_name, round(b.d, 6) AS baseline_duration, round(r.d, 6) AS recent_duration, round((r.d - b.d) / nullif(b.d, 0) * 100, 2) AS duration_change_pct,
    round(b.q * 100, 6) AS baseline_quality_pct, round(r.q * 100, 6) AS recent_quality_pct, round((r.q - b.q) * 100, 2) AS quality_change_pct,
    CASE WHEN r.d > b.d + 2 * b.s OR r.q < b.q - 0.05 THEN '⚠️ DEGRADED' ELSE '✅ NORMAL' END AS performance_status,
    CASE WHEN r.d > b.d + 2 * b.s THEN concat('Execution time increased by ', cast(cast(round((r.d - b.d) / nullif(b.d, 0) * 100, 0) AS bigint) AS varchar), '%')
         WHEN r.q < b.q - 0.05 THEN concat('Data quality dropped by ', cast(round((r.q - b.q) * 100, 1) AS varchar), ' percentage points') ELSE 'Performance within normal range' END AS alert_message
  FROM recent r JOIN base b ON r.pipeline_name = b.pipeline_name WHERE r.n >= 3)"""


def rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


def dashboard(t):
    return ops.sla_dashboard(t["ingest_run"], SLAS, EVENT_AS_OF)


def degradation(t):
    return ops.performance_degradation(t["ingest_run"], EVENT_AS_OF)


@case("r1_sla_dashboard", f"{SLA_SQL} SELECT * FROM sla")
def _(t):
    return rounded(dashboard(t), "actual_value")


@case("r2_degradation", f"{DEGRADATION_SQL} SELECT * FROM degradation")
def _(t):
    return rounded(degradation(t), "baseline_duration", "recent_duration", "baseline_quality_pct", "recent_quality_pct")


@case(
    "r3_new_alerts",
    f"""{SLA_SQL}, {DEGRADATION_SQL.strip()[5:].replace("recent AS", "recent2 AS").replace("FROM recent r", "FROM recent2 r")},
    opened AS (SELECT * FROM alerts WHERE alert_status = 'OPEN')
    SELECT pipeline_name, 'SLA_BREACH' AS alert_type, severity, metric_type AS metric_name, round(actual_value, 2) AS actual_value, threshold_value, status_message AS alert_message, 'OPEN' AS alert_status, {AS_OF} AS detected_at
    FROM sla WHERE sla_status = '❌ BREACH' AND NOT EXISTS (SELECT 1 FROM opened a WHERE a.pipeline_name = sla.pipeline_name AND a.metric_name = sla.metric_type AND a.detected_at >= {AS_OF} - INTERVAL '1' HOUR)
    UNION ALL
    SELECT pipeline_name, 'DEGRADATION', 'WARNING', 'PERFORMANCE', round(recent_duration, 2), round(baseline_duration, 2), alert_message, 'OPEN', {AS_OF}
    FROM degradation d WHERE performance_status = '⚠️ DEGRADED' AND NOT EXISTS (SELECT 1 FROM opened a WHERE a.pipeline_name = d.pipeline_name AND a.alert_type = 'DEGRADATION' AND a.detected_at >= {AS_OF} - INTERVAL '4' HOUR)""",
)
def _(t):
    return ops.new_alerts(dashboard(t), degradation(t), t["alerts"], EVENT_AS_OF)


@case("r3_open_counts", "SELECT count(*) AS alert_count, count(*) FILTER (severity = 'CRITICAL') AS critical_count, count(*) FILTER (severity = 'WARNING') AS warning_count FROM alerts WHERE alert_status = 'OPEN'")
def _(t):
    return ops.open_alert_counts(t["alerts"])


@case(
    "r4_monitoring_widgets",
    f"""{SLA_SQL},
    day AS (SELECT * FROM ingest_run WHERE executed_at >= {AS_OF} - INTERVAL '1' DAY)
    SELECT 'Pipeline Health' AS widget_name, 'STATUS' AS widget_type, cast(count(DISTINCT pipeline_name) AS double) AS v1, cast(count(DISTINCT CASE WHEN executed_at >= {AS_OF} - INTERVAL '1' HOUR THEN pipeline_name END) AS double) AS v2,
      round(cast(count(*) FILTER (run_status = 'SUCCESS') AS double) / count(*) * 100, 2) AS v3 FROM day
    UNION ALL SELECT 'SLA Compliance', 'GAUGE', cast(count(*) FILTER (sla_status = '✅ OK') AS double), cast(count(*) FILTER (sla_status = '❌ BREACH') AS double), round(cast(count(*) FILTER (sla_status = '✅ OK') AS double) / count(*) * 100, 2) FROM sla
    UNION ALL SELECT 'Active Alerts', 'ALERT_LIST', cast(count(*) FILTER (severity = 'CRITICAL') AS double), cast(count(*) FILTER (severity = 'WARNING') AS double), cast(count(*) AS double) FROM alerts WHERE alert_status = 'OPEN'
    UNION ALL SELECT 'Performance Trends', 'TIMESERIES', round(avg(cast(execution_duration_sec AS double)), 4), round(avg(cast(source_row_count AS double) / nullif(cast(execution_duration_sec AS double), 0)), 4), round(avg({QUALITY}), 4) FROM day""",
)
def _(t):
    """The widgets' JSON, read back as numbers."""
    fields = {
        "Pipeline Health": ("total_pipelines", "active_last_hour", "success_rate"), "SLA Compliance": ("compliant", "breached", "compliance_rate"),
        "Active Alerts": ("critical", "warning", "total"), "Performance Trends": ("avg_latency_sec", "avg_throughput", "avg_quality_pct"),
    }
    widgets = ops.monitoring_widgets(t["ingest_run"], dashboard(t), t["alerts"], EVENT_AS_OF)

    def value(position):
        number = F.lit(None).cast("double")
        for name, names in fields.items():
            found = F.get_json_object("widget_data", f"$.{names[position]}").cast("double")
            number = F.when(F.col("widget_name") == name, F.round(found, 4)).otherwise(number)
        return number

    return widgets.select("widget_name", "widget_type", value(0).alias("v1"), value(1).alias("v2"), value(2).alias("v3"))


ALERT_COLUMNS = "alert_id, pipeline_name, alert_type, severity, metric_name, cast(actual_value AS double) AS actual_value, cast(threshold_value AS double) AS threshold_value, alert_message, alert_status, detected_at"


@case("r5_open_alerts", f"SELECT {ALERT_COLUMNS} FROM alerts WHERE alert_status = 'OPEN'")
def _(t):
    return ops.open_alerts(t["alerts"])


@case(
    "r6_lineage",
    """SELECT 'BRONZE' AS layer, year(created_at) AS ingest_run_id, cast(NULL AS varchar) AS batch_id, count(*) AS record_count, min(created_at) AS first_record, max(updated_at) AS last_record FROM fact_order GROUP BY year(created_at)
       UNION ALL SELECT 'SILVER', NULL, concat('BATCH_', cast(year(created_at) AS varchar)), count(*), min(created_at), max(updated_at) FROM fact_order WHERE restaurant_id IS NOT NULL GROUP BY year(created_at)
       UNION ALL SELECT 'GOLD', NULL, concat('BATCH_', cast(year(created_at) AS varchar)), count(*), min(created_at), max(updated_at) FROM fact_order WHERE restaurant_id IS NOT NULL AND order_status <> 'CANCELLED' GROUP BY year(created_at)""",
)
def _(t):
    run = F.year("created_at")
    bronze = t["fact_order"].withColumn("ingest_run_id", run)
    silver = t["fact_order"].where(F.col("restaurant_id").isNotNull()).withColumn("batch_id", F.concat(F.lit("BATCH_"), run.cast("string")))
    return ops.lineage(bronze, silver, silver.where(F.col("order_status") != "CANCELLED"))


RETRY_ROWS = ", ".join(f"('{r.error_type}', {r.max_retries}, {r.delay_seconds})" for r in RETRIES)
RETRY_SQL = f"""
WITH retry_config(error_type, max_retries, delay) AS (VALUES {RETRY_ROWS}),
eligible AS (
  SELECT d.*, cast(c.max_retries AS bigint) AS max_retries, cast(c.delay AS bigint) AS retry_delay_seconds FROM dead_letter d JOIN retry_config c ON d.error_type = c.error_type
  WHERE d.processing_status = 'PENDING' AND d.retry_count < c.max_retries
    AND (d.last_retry_at IS NULL OR floor(epoch({AS_OF})) - floor(epoch(d.last_retry_at)) > c.delay * pow(2, d.retry_count)))"""
RETRY_COLUMNS = "dlq_id, pipeline_name, error_type, record_data, processing_status, retry_count, last_retry_at, created_at, max_retries, retry_delay_seconds"


@case("r7_retry_candidates", f"{RETRY_SQL} SELECT {RETRY_COLUMNS} FROM eligible")
def _(t):
    return ops.retry_candidates(t["dead_letter"], RETRIES, EVENT_AS_OF)


@case("r7_retry_batch", f"{RETRY_SQL} SELECT {RETRY_COLUMNS} FROM eligible ORDER BY created_at, dlq_id LIMIT 100")
def _(t):
    return ops.retry_candidates(t["dead_letter"], RETRIES, EVENT_AS_OF, limit=100)


@case(
    "r7_settled_queue",
    f"""{RETRY_SQL} SELECT d.dlq_id, d.pipeline_name, d.error_type, d.record_data,
      CASE WHEN e.dlq_id IS NULL THEN d.processing_status WHEN try_cast(json_extract_string(d.record_data, '$.k') AS integer) < 50 THEN 'RESOLVED' WHEN d.retry_count + 1 >= e.max_retries THEN 'ABANDONED' ELSE 'PENDING' END AS processing_status,
      CASE WHEN e.dlq_id IS NULL THEN d.retry_count ELSE d.retry_count + 1 END AS retry_count, CASE WHEN e.dlq_id IS NULL THEN d.last_retry_at ELSE {AS_OF} END AS last_retry_at, d.created_at
      FROM dead_letter d LEFT JOIN eligible e ON d.dlq_id = e.dlq_id""",
)
def _(t):
    """A retry succeeds when the payload's number is below 50."""
    tried = ops.retry_candidates(t["dead_letter"], RETRIES, EVENT_AS_OF)
    outcome = tried.select("dlq_id", (F.get_json_object("record_data", "$.k").cast("int") < 50).alias("succeeded"))
    return ops.settle_retries(t["dead_letter"], tried, outcome, EVENT_AS_OF)


RECON_SQL = """
WITH counts AS (
  SELECT cast(o_orderpriority AS varchar) AS batch_id, count(*) AS bronze, count(*) FILTER (o_orderpriority <> '5-LOW' OR o_totalprice > 4000) AS silver,
    count(*) FILTER (o_orderpriority IN ('1-URGENT', '2-HIGH') OR (o_orderpriority = '5-LOW' AND o_totalprice > 4000) OR (o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '5-LOW') AND o_orderstatus <> 'F')) AS gold
  FROM orders GROUP BY 1),
judged AS (
  SELECT *, abs(bronze - silver) + abs(silver - gold) AS discrepancies,
    CASE WHEN abs(bronze - silver) + abs(silver - gold) = 0 THEN 'PASS' WHEN abs(bronze - silver) + abs(silver - gold) <= bronze * 0.01 THEN 'WARNING' ELSE 'FAIL' END AS reconciliation_status FROM counts),
recon AS (
  SELECT 'ORDER_BATCH' AS pipeline_name, batch_id, 'BRONZE->SILVER' AS layer, bronze AS source_count, silver AS target_count, least(bronze, silver) AS matched_count, bronze - silver AS missing_in_target, reconciliation_status, discrepancies FROM judged
  UNION ALL SELECT 'ORDER_BATCH', batch_id, 'SILVER->GOLD', silver, gold, least(silver, gold), silver - gold, reconciliation_status, discrepancies FROM judged)"""


def reconciliation(t):
    urgent, low = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.col("o_orderpriority") == "5-LOW"
    dear = F.col("o_totalprice") > 4000
    counts = t["orders"].groupBy(F.lit("ORDER_BATCH").alias("pipeline_name"), F.col("o_orderpriority").alias("batch_id")).agg(
        F.count(F.lit(1)).alias("bronze"), F.count_if(~low | dear).alias("silver"),
        F.count_if(urgent | (low & dear) | (~urgent & ~low & (F.col("o_orderstatus") != "F"))).alias("gold"),
    )
    return ops.reconcile_counts(counts)


@case("r8_reconcile", f"{RECON_SQL} SELECT * FROM recon")
def _(t):
    return reconciliation(t)


SUMMARY_SQL = f"""
WITH summary AS (
  SELECT pipeline_name, error_type, count(*) AS error_count, count(*) FILTER (processing_status = 'PENDING') AS pending_count, count(*) FILTER (processing_status = 'RETRYING') AS retrying_count,
    count(*) FILTER (processing_status = 'RESOLVED') AS resolved_count, count(*) FILTER (processing_status = 'ABANDONED') AS abandoned_count, avg(retry_count) AS avg_retry_count,
    min(created_at) AS first_error, max(created_at) AS last_error FROM dead_letter WHERE created_at >= {AS_OF} - INTERVAL '7' DAY GROUP BY 1, 2)"""


def summary(t):
    return ops.error_summary(t["dead_letter"], EVENT_AS_OF)


@case("r10_error_summary", f"{SUMMARY_SQL} SELECT * FROM summary")
def _(t):
    return summary(t)


@case("r11_duration_stats", "SELECT pipeline_name, cast(sum(execution_duration_sec) AS double) / count(*) AS avg_duration, cast(max(execution_duration_sec) AS double) AS max_duration FROM ingest_run GROUP BY 1")
def _(t):
    return ops.duration_stats(t["ingest_run"])


@case("r11_run_history", "SELECT ingest_run_id, pipeline_name, run_status, executed_at FROM ingest_run")
def _(t):
    return ops.run_history(t["ingest_run"]).select("ingest_run_id", "pipeline_name", "run_status", "executed_at")


@case(
    "d29_latest_runs",
    f"""SELECT CASE WHEN run_status = 'SUCCESS' THEN '✅' ELSE '❌' END AS status_icon, ingest_run_id, pipeline_name, source_row_count, valid_row_count, round({QUALITY}, 2) AS quality_pct,
      cast(execution_duration_sec AS double) AS execution_duration_sec, executed_at FROM ingest_run WHERE executed_at >= {AS_OF} - INTERVAL '7' DAY ORDER BY executed_at DESC, ingest_run_id LIMIT 15""",
)
def _(t):
    return ops.latest_runs(t["ingest_run"], EVENT_AS_OF)


@case("d30_sla_totals", f"{SLA_SQL} SELECT count(*) AS total_slas, count(*) FILTER (sla_status = '✅ OK') AS compliant, count(*) FILTER (sla_status <> '✅ OK') AS breached, round(cast(count(*) FILTER (sla_status = '✅ OK') AS double) / count(*) * 100, 1) AS compliant_pct FROM sla")
def _(t):
    return ops.sla_totals(dashboard(t))


@case("d30_sla_breaches", f"{SLA_SQL} SELECT severity, count(*) AS breaches FROM sla WHERE sla_status = '❌ BREACH' GROUP BY 1")
def _(t):
    return ops.sla_breaches_by_severity(dashboard(t))


@case("d30_sla_metrics", f"{SLA_SQL} SELECT metric_type, sla_status, count(*) AS count FROM sla GROUP BY 1, 2")
def _(t):
    return ops.sla_by_metric(dashboard(t))


@case("d31_alert_list", f"SELECT {ALERT_COLUMNS} FROM alerts WHERE alert_status = 'OPEN' AND severity IN ('CRITICAL')")
def _(t):
    return ops.open_alerts(t["alerts"], ["CRITICAL"])


@case("d32_dlq_totals", f"{SUMMARY_SQL} SELECT " + ", ".join(f"cast(sum({n}_count) AS bigint) AS {n}_count" for n in ("error", "pending", "resolved", "abandoned")) + " FROM summary")
def _(t):
    return ops.dlq_totals(summary(t))


@case("d32_dlq_by_worker", f"{SUMMARY_SQL} SELECT pipeline_name, cast(sum(error_count) AS bigint) AS error_count FROM summary GROUP BY 1")
def _(t):
    return ops.dlq_by(summary(t), "pipeline_name")


@case("d32_dlq_by_type", f"{SUMMARY_SQL} SELECT error_type, cast(sum(error_count) AS bigint) AS error_count FROM summary GROUP BY 1")
def _(t):
    return ops.dlq_by(summary(t), "error_type")


@case("d32_dlq_resolution", f"{SUMMARY_SQL} SELECT *, round(cast(resolved_count AS double) / error_count * 100, 1) AS resolution_rate FROM summary")
def _(t):
    return ops.dlq_resolution(summary(t))


@case("d33_reconciliations", f"{RECON_SQL} SELECT *, {AS_OF} AS reconciled_at, round(cast(matched_count AS double) / source_count * 100, 2) AS match_pct FROM recon ORDER BY batch_id, layer LIMIT 50")
def _(t):
    return ops.latest_reconciliations(reconciliation(t).withColumn("reconciled_at", F.lit(EVENT_AS_OF).cast("timestamp_ntz")))


@case("d33_by_layer", f"{RECON_SQL} SELECT layer, reconciliation_status, count(*) AS count FROM recon GROUP BY 1, 2")
def _(t):
    return ops.reconciliation_by(reconciliation(t), "layer")


@case("d33_by_worker", f"{RECON_SQL} SELECT pipeline_name, reconciliation_status, count(*) AS count FROM recon GROUP BY 1, 2")
def _(t):
    return ops.reconciliation_by(reconciliation(t), "pipeline_name")


TRENDS = f"""SELECT ingest_run_id, pipeline_name, cast(execution_duration_sec AS double) AS execution_duration_sec, executed_at, cast(source_row_count AS double) / nullif(cast(execution_duration_sec AS double), 0) AS throughput,
  round({QUALITY}, 2) AS quality_pct FROM ingest_run WHERE executed_at >= {AS_OF} - INTERVAL '7' DAY"""


@case("d34_run_trends", TRENDS)
def _(t):
    return ops.run_trends(t["ingest_run"], EVENT_AS_OF)


@case("d34_throughput", f"SELECT pipeline_name, round(avg(throughput), 4) AS throughput FROM ({TRENDS}) x GROUP BY 1")
def _(t):
    return ops.throughput_by_pipeline(ops.run_trends(t["ingest_run"], EVENT_AS_OF)).withColumn("throughput", F.round("throughput", 4))


@case("d34_degraded", f"{DEGRADATION_SQL} SELECT count(*) FILTER (performance_status = '⚠️ DEGRADED') AS degraded, count(*) FILTER (performance_status <> '⚠️ DEGRADED') AS normal FROM degradation")
def _(t):
    return ops.degraded_counts(degradation(t))
