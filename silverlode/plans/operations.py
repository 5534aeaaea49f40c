"""Operational views: service levels, degradation, alerts, lineage, retries, reconciliation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.config import Retry, Sla
from silverlode.functions.scalar import as_timestamp
from silverlode.operators.joins import wildcard_join

# Labels of the views.
BREACH, OK = "❌ BREACH", "✅ OK"
DEGRADED, NORMAL = "⚠️ DEGRADED", "✅ NORMAL"


def _ago(as_of, amount: int, unit: str) -> Column:
    return as_timestamp(as_of) - F.expr(f"INTERVAL {int(amount)} {unit}")


def _ratio(top: str, bottom: str) -> Column:
    return F.col(top).cast("double") / F.nullif(F.col(bottom).cast("double"), F.lit(0.0))


def sla_frame(spark: SparkSession, slas: Sequence[Sla]) -> DataFrame:
    rows = [(s.pipeline_name, s.metric_type, s.threshold, s.operator, s.unit, s.severity) for s in slas if s.active]
    names = "pipeline_name string, metric_type string, t string, threshold_operator string, measurement_unit string, severity string"
    frame = spark.createDataFrame(rows, names)
    return frame.withColumn("threshold_value", F.col("t").cast("decimal(10,2)")).drop("t")


def sla_dashboard(runs: DataFrame, slas: Sequence[Sla], as_of) -> DataFrame:
    """Each pipeline's last 24 hours against the service levels that name it or ALL."""
    good = F.when(F.col("source_row_count") > 0, F.col("valid_row_count").cast("double") / F.col("source_row_count") * 100)
    recent = runs.where(F.col("executed_at") >= _ago(as_of, 24, "HOURS")).groupBy("pipeline_name").agg(
        F.avg(F.col("execution_duration_sec").cast("double")).alias("_latency"),
        F.avg(F.coalesce(good, F.lit(100.0))).alias("_quality"),
        (F.count_if(F.col("run_status") == "SUCCESS").cast("double") / F.count(F.lit(1)) * 100).alias("_availability"),
        (F.sum("source_row_count").cast("double") / F.nullif(F.sum(F.col("execution_duration_sec").cast("double")), F.lit(0.0))).alias("_throughput"),
    )
    matched = wildcard_join(recent, sla_frame(runs.sparkSession, slas), "pipeline_name")
    metric = F.col("metric_type")
    actual = (
        F.when(metric == "LATENCY", F.col("_latency"))
        .when(metric == "QUALITY", F.col("_quality"))
        .when(metric == "AVAILABILITY", F.col("_availability"))
        .when(metric == "THROUGHPUT", F.col("_throughput"))
    )
    limit, operator = F.col("threshold_value").cast("double"), F.col("threshold_operator")
    value = F.col("actual_value")
    breach = (
        F.when(operator == ">", value > limit)
        .when(operator == "<", value < limit)
        .when(operator == ">=", value >= limit)
        .when(operator == "<=", value <= limit)
        .when(operator == "=", value == limit)
    )
    broken = F.coalesce(F.col("is_breach"), F.lit(False))
    return (
        matched.withColumn("actual_value", actual)
        .withColumn("is_breach", breach)
        .select(
            "pipeline_name", "metric_type", "actual_value", "threshold_value",
            F.concat_ws(" ", "threshold_operator", F.col("threshold_value").cast("string"), "measurement_unit").alias("sla_threshold"),
            F.when(broken, BREACH).otherwise(OK).alias("sla_status"),
            "severity",
            F.when(broken, "Exceeds SLA threshold").otherwise("Within acceptable range").alias("status_message"),
        )
        .orderBy(F.col("sla_status") == OK, F.col("severity").desc(), "pipeline_name")
    )


def performance_degradation(runs: DataFrame, as_of, min_runs: int = 3) -> DataFrame:
    """Last 24 hours against days -7 to -1, in one pass over the last week."""
    at = F.col("executed_at")
    day_ago = _ago(as_of, 1, "DAYS")
    base, recent = at < day_ago, at >= day_ago
    seconds, quality = F.col("execution_duration_sec").cast("double"), _ratio("valid_row_count", "source_row_count")
    figures = runs.where(at >= _ago(as_of, 7, "DAYS")).groupBy("pipeline_name").agg(
        F.avg(F.when(base, seconds)).alias("baseline_duration"),
        F.stddev(F.when(base, seconds)).alias("_spread"),
        F.avg(F.when(base, quality)).alias("_base_quality"),
        F.count_if(base).alias("_base_runs"),
        F.avg(F.when(recent, seconds)).alias("recent_duration"),
        F.avg(F.when(recent, quality)).alias("_recent_quality"),
        F.count_if(recent).alias("_recent_runs"),
    )
    slow = F.col("recent_duration") > F.col("baseline_duration") + 2 * F.col("_spread")
    worse = F.col("_recent_quality") < F.col("_base_quality") - 0.05
    change = (F.col("recent_duration") - F.col("baseline_duration")) / F.nullif(F.col("baseline_duration"), F.lit(0.0)) * 100
    drop = (F.col("_recent_quality") - F.col("_base_quality")) * 100
    return (
        figures.where((F.col("_recent_runs") >= min_runs) & (F.col("_base_runs") > 0))
        .select(
            "pipeline_name", "baseline_duration", "recent_duration",
            F.round(change, 2).alias("duration_change_pct"),
            (F.col("_base_quality") * 100).alias("baseline_quality_pct"),
            (F.col("_recent_quality") * 100).alias("recent_quality_pct"),
            F.round(drop, 2).alias("quality_change_pct"),
            F.when(slow | worse, DEGRADED).otherwise(NORMAL).alias("performance_status"),
            F.when(slow, F.concat(F.lit("Execution time increased by "), F.round(change, 0).cast("bigint").cast("string"), F.lit("%")))
            .when(worse, F.concat(F.lit("Data quality dropped by "), F.round(drop, 1).cast("string"), F.lit(" percentage points")))
            .otherwise("Performance within normal range").alias("alert_message"),
        )
        .orderBy(F.col("performance_status").desc(), F.col("duration_change_pct").desc())
    )


def new_alerts(sla: DataFrame, degradation: DataFrame, alerts: DataFrame, as_of) -> DataFrame:
    """Alerts to add: none while one of the same kind is open (1 h per metric, 4 h for degradation)."""
    opened = alerts.where(F.col("alert_status") == "OPEN")
    breaches = sla.where(F.col("sla_status") == BREACH).select(
        "pipeline_name", F.lit("SLA_BREACH").alias("alert_type"), "severity", F.col("metric_type").alias("metric_name"),
        F.round("actual_value", 2).alias("actual_value"), F.col("threshold_value").cast("double").alias("threshold_value"),
        F.col("status_message").alias("alert_message"),
    )
    held = opened.where(F.col("detected_at") >= _ago(as_of, 1, "HOURS")).select("pipeline_name", "metric_name")
    slow = degradation.where(F.col("performance_status") == DEGRADED).select(
        "pipeline_name", F.lit("DEGRADATION").alias("alert_type"), F.lit("WARNING").alias("severity"),
        F.lit("PERFORMANCE").alias("metric_name"), F.round("recent_duration", 2).alias("actual_value"),
        F.round("baseline_duration", 2).alias("threshold_value"), "alert_message",
    )
    held_slow = opened.where(
        (F.col("alert_type") == "DEGRADATION") & (F.col("detected_at") >= _ago(as_of, 4, "HOURS"))
    ).select("pipeline_name")
    added = breaches.join(held, ["pipeline_name", "metric_name"], "left_anti").unionByName(
        slow.join(held_slow, "pipeline_name", "left_anti")
    )
    return added.withColumn("alert_status", F.lit("OPEN")).withColumn("detected_at", as_timestamp(as_of))


def open_alert_counts(alerts: DataFrame) -> DataFrame:
    severity = F.col("severity")
    return alerts.where(F.col("alert_status") == "OPEN").agg(
        F.count(F.lit(1)).alias("alert_count"),
        F.count_if(severity == "CRITICAL").alias("critical_count"),
        F.count_if(severity == "WARNING").alias("warning_count"),
    )


def open_alerts(alerts: DataFrame, severities: Sequence[str] | None = None) -> DataFrame:
    rows = alerts.where(F.col("alert_status") == "OPEN")
    if severities is not None:
        rows = rows.where(F.col("severity").isin(*severities))
    return rows.orderBy(F.col("severity").desc(), F.col("detected_at").desc())


def monitoring_widgets(runs: DataFrame, sla: DataFrame, alerts: DataFrame, as_of) -> DataFrame:
    """Four one-row aggregates as JSON objects."""

    def widget(name: str, kind: str, frame: DataFrame) -> DataFrame:
        data = F.to_json(F.struct(*frame.columns), {"ignoreNullFields": "false"})
        return frame.select(F.lit(name).alias("widget_name"), F.lit(kind).alias("widget_type"), data.alias("widget_data"))

    last_day = runs.where(F.col("executed_at") >= _ago(as_of, 1, "DAYS"))
    ok, status = F.col("run_status") == "SUCCESS", F.col("sla_status")
    health = last_day.agg(
        F.count_distinct("pipeline_name").alias("total_pipelines"),
        F.count_distinct(F.when(F.col("executed_at") >= _ago(as_of, 1, "HOURS"), F.col("pipeline_name"))).alias("active_last_hour"),
        F.round(F.count_if(ok).cast("double") / F.nullif(F.count(F.lit(1)), F.lit(0)) * 100, 2).alias("success_rate"),
        F.count_if(F.col("run_status") == "FAILED").alias("failed_runs"),
    )
    compliance = sla.agg(
        F.count_if(status == OK).alias("compliant"),
        F.count_if(status == BREACH).alias("breached"),
        F.round(F.count_if(status == OK).cast("double") / F.nullif(F.count(F.lit(1)), F.lit(0)) * 100, 2).alias("compliance_rate"),
    )
    severity = F.col("severity")
    active = alerts.where(F.col("alert_status") == "OPEN").agg(
        F.count_if(severity == "CRITICAL").alias("critical"),
        F.count_if(severity == "WARNING").alias("warning"),
        F.count(F.lit(1)).alias("total"),
    )
    trends = last_day.agg(
        F.avg(F.col("execution_duration_sec").cast("double")).alias("avg_latency_sec"),
        F.avg(_ratio("source_row_count", "execution_duration_sec")).alias("avg_throughput"),
        F.avg(_ratio("valid_row_count", "source_row_count") * 100).alias("avg_quality_pct"),
    )
    return (
        widget("Pipeline Health", "STATUS", health)
        .unionByName(widget("SLA Compliance", "GAUGE", compliance))
        .unionByName(widget("Active Alerts", "ALERT_LIST", active))
        .unionByName(widget("Performance Trends", "TIMESERIES", trends))
    )


def lineage(bronze: DataFrame, silver: DataFrame, gold: DataFrame) -> DataFrame:
    """Row count, first and last record per run (Bronze) or batch (Silver, Gold)."""

    def layer(name: str, frame: DataFrame, run, batch) -> DataFrame:
        keys = [k for k in ("ingest_run_id", "batch_id") if k in (run, batch)]
        grouped = frame.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("record_count"),
            F.min("created_at").alias("first_record"),
            F.max("updated_at").alias("last_record"),
        )
        return grouped.select(
            F.lit(name).alias("layer"),
            (F.col(run) if run else F.lit(None)).cast("bigint").alias("ingest_run_id"),
            (F.col(batch) if batch else F.lit(None)).cast("string").alias("batch_id"),
            "record_count", "first_record", "last_record",
        )

    return (
        layer("BRONZE", bronze, "ingest_run_id", None)
        .unionByName(layer("SILVER", silver, None, "batch_id"))
        .unionByName(layer("GOLD", gold.where(F.col("status") == "ACTIVE"), None, "batch_id"))
        .orderBy(F.col("first_record").desc(), "layer")
    )


def retry_frame(spark: SparkSession, retries: Sequence[Retry]) -> DataFrame:
    rows = [
        (r.pipeline_name, r.error_type, r.max_retries, r.delay_seconds, float(r.multiplier if r.backoff else 1.0))
        for r in retries if r.active
    ]
    return spark.createDataFrame(
        rows, "pipeline_name string, error_type string, max_retries int, retry_delay_seconds int, backoff double"
    )


def retry_candidates(
    letters: DataFrame, retries: Sequence[Retry], as_of, limit: int | None = None, backoff: bool = True
) -> DataFrame:
    """Pending letters with retries left whose delay has passed, oldest first.

    With ``backoff`` the delay grows by the multiplier for every earlier retry.
    """
    pending = letters.where(F.col("processing_status") == "PENDING")
    config = retry_frame(letters.sparkSession, retries)
    offered = pending.withColumn("_match", F.explode(F.array_distinct(F.array("pipeline_name", F.lit("ALL")))))
    config = config.withColumnRenamed("pipeline_name", "_match")
    joined = offered.join(config, ["_match", "error_type"]).drop("_match")
    waited = F.unix_seconds(as_timestamp(as_of).cast("timestamp")) - F.unix_seconds(F.col("last_retry_at").cast("timestamp"))
    delay = F.col("retry_delay_seconds").cast("double")
    if backoff:
        delay = delay * F.pow("backoff", F.col("retry_count").cast("double"))
    ready = F.col("last_retry_at").isNull() | (waited > delay)
    chosen = joined.where((F.col("retry_count") < F.col("max_retries")) & ready).drop("backoff").orderBy("created_at", "dlq_id")
    return chosen if limit is None else chosen.limit(limit)


def settle_retries(letters: DataFrame, attempted: DataFrame, outcome: DataFrame, as_of) -> DataFrame:
    """The queue after a retry: ``attempted`` (dlq_id, max_retries), ``outcome`` (dlq_id, succeeded)."""
    tried = attempted.select("dlq_id", F.col("max_retries").alias("_max")).join(
        outcome.select("dlq_id", F.col("succeeded").alias("_ok")), "dlq_id", "left"
    )
    joined = letters.join(tried, "dlq_id", "left")
    hit, won = F.col("_max").isNotNull(), F.coalesce(F.col("_ok"), F.lit(False))
    count = F.col("retry_count") + F.when(hit, 1).otherwise(0)
    state = (
        F.when(~hit, F.col("processing_status"))
        .when(won, "RESOLVED")
        .when(count >= F.col("_max"), "ABANDONED")
        .otherwise("PENDING")
    )
    now = as_timestamp(as_of)
    changed = {
        "processing_status": state,
        "retry_count": count,
        "last_retry_at": F.when(hit, now).otherwise(F.col("last_retry_at")),
    }
    return joined.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in letters.columns])


def reconcile_counts(counts: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Two log rows per batch from its three layer counts (bronze, silver, gold)."""
    bronze, silver, gold = F.col("bronze"), F.col("silver"), F.col("gold")
    off = F.abs(bronze - silver) + F.abs(silver - gold)
    status = F.when(off == 0, "PASS").when(off <= bronze * tolerance, "WARNING").otherwise("FAIL")

    def step(name: str, source: Column, target: Column) -> Column:
        return F.struct(
            F.lit(name).alias("layer"), source.alias("source_count"), target.alias("target_count"),
            F.least(source, target).alias("matched_count"), (source - target).alias("missing_in_target"),
        )

    steps = F.explode(F.array(step("BRONZE->SILVER", bronze, silver), step("SILVER->GOLD", silver, gold)))
    return counts.select(
        "pipeline_name", "batch_id", status.alias("reconciliation_status"), off.alias("discrepancies"), steps.alias("_s")
    ).select("pipeline_name", "batch_id", "_s.*", "reconciliation_status", "discrepancies")


def error_summary(letters: DataFrame, as_of, days: int = 7) -> DataFrame:
    state = F.col("processing_status")
    return (
        letters.where(F.col("created_at") >= _ago(as_of, days, "DAYS"))
        .groupBy("pipeline_name", "error_type")
        .agg(
            F.count(F.lit(1)).alias("error_count"),
            *[F.count_if(state == s).alias(f"{s.lower()}_count") for s in ("PENDING", "RETRYING", "RESOLVED", "ABANDONED")],
            F.avg("retry_count").alias("avg_retry_count"),
            F.min("created_at").alias("first_error"),
            F.max("created_at").alias("last_error"),
        )
        .orderBy(F.col("error_count").desc())
    )


def duration_stats(runs: DataFrame) -> DataFrame:
    seconds = F.col("execution_duration_sec")
    return runs.groupBy("pipeline_name").agg(
        (F.sum(seconds).cast("double") / F.count(seconds)).alias("avg_duration"), F.max(seconds).alias("max_duration")
    )


def failed_runs(runs: DataFrame) -> DataFrame:
    return runs.where(F.col("run_status") == "FAILED")


def run_history(runs: DataFrame, at: str = "executed_at") -> DataFrame:
    return runs.orderBy(F.col(at).desc())


def run_errors(errors: DataFrame, run_id: int) -> DataFrame:
    return errors.where(F.col("ingest_run_id") == run_id)


# ---- dashboard views over the operational tables -----------------------------------------


def latest_runs(runs: DataFrame, as_of, k: int = 15) -> DataFrame:
    quality = F.col("valid_row_count").cast("double") / F.col("source_row_count") * 100
    rows = runs.where(F.col("executed_at") >= _ago(as_of, 7, "DAYS"))
    return rows.orderBy(F.col("executed_at").desc(), "ingest_run_id").limit(k).select(
        F.when(F.col("run_status") == "SUCCESS", "✅").otherwise("❌").alias("status_icon"),
        "ingest_run_id", "pipeline_name", "source_row_count", "valid_row_count", F.round(quality, 2).alias("quality_pct"),
        "execution_duration_sec", "executed_at",
    )


def sla_totals(sla: DataFrame) -> DataFrame:
    ok = F.count_if(F.col("sla_status") == OK)
    rows = F.count(F.lit(1))
    return sla.agg(
        rows.alias("total_slas"), ok.alias("compliant"), (rows - ok).alias("breached"),
        F.round(ok.cast("double") / F.nullif(rows, F.lit(0)) * 100, 1).alias("compliant_pct"),
    )


def sla_breaches_by_severity(sla: DataFrame) -> DataFrame:
    return sla.where(F.col("sla_status") == BREACH).groupBy("severity").agg(F.count(F.lit(1)).alias("breaches"))


def sla_by_metric(sla: DataFrame) -> DataFrame:
    return sla.groupBy("metric_type", "sla_status").agg(F.count(F.lit(1)).alias("count"))


def dlq_totals(summary: DataFrame) -> DataFrame:
    names = ["error_count", "pending_count", "resolved_count", "abandoned_count"]
    return summary.agg(*[F.sum(n).alias(n) for n in names])


def dlq_by(summary: DataFrame, column: str) -> DataFrame:
    return summary.groupBy(column).agg(F.sum("error_count").alias("error_count"))


def dlq_resolution(summary: DataFrame) -> DataFrame:
    rate = F.col("resolved_count").cast("double") / F.col("error_count") * 100
    return summary.withColumn("resolution_rate", F.round(rate, 1))


def latest_reconciliations(log: DataFrame, k: int = 50) -> DataFrame:
    match = F.col("matched_count").cast("double") / F.nullif(F.col("source_count").cast("double"), F.lit(0.0)) * 100
    return log.orderBy(F.col("reconciled_at").desc(), "batch_id", "layer").limit(k).withColumn("match_pct", F.round(match, 2))


def reconciliation_by(log: DataFrame, column: str) -> DataFrame:
    return log.groupBy(column, "reconciliation_status").agg(F.count(F.lit(1)).alias("count"))


def run_trends(runs: DataFrame, as_of) -> DataFrame:
    rows = runs.where(F.col("executed_at") >= _ago(as_of, 7, "DAYS"))
    quality = F.col("valid_row_count").cast("double") / F.col("source_row_count") * 100
    return rows.select(
        "ingest_run_id", "pipeline_name", "execution_duration_sec", "executed_at",
        _ratio("source_row_count", "execution_duration_sec").alias("throughput"), F.round(quality, 2).alias("quality_pct"),
    ).orderBy(F.col("executed_at").desc())


def throughput_by_pipeline(trends: DataFrame) -> DataFrame:
    return trends.groupBy("pipeline_name").agg(F.avg("throughput").alias("throughput"))


def degraded_counts(degradation: DataFrame) -> DataFrame:
    status = F.col("performance_status")
    return degradation.agg(F.count_if(status == DEGRADED).alias("degraded"), F.count_if(status == NORMAL).alias("normal"))
