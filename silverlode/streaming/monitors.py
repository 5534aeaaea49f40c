"""Stream monitors and end-to-end checks, as views over landing and Gold tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.functions.scalar import as_timestamp, boundary_diff
from silverlode.streaming.jobs import windowed

# Labels and limits of the monitors.
OK = "✓ OK"
BACKLOG_LIMIT, IDLE_MINUTES, LATENCY_MINUTES = 1000, 10, 5


def _since(rows: DataFrame, column: str, as_of, hours: int) -> DataFrame:
    return rows.where(F.col(column) >= as_timestamp(as_of) - F.expr(f"INTERVAL {int(hours)} HOURS"))


def throughput(landed: DataFrame, as_of, hours: int = 1) -> DataFrame:
    recent = _since(landed, "ingested_at", as_of, hours)
    return windowed(recent, "ingested_at", "1 minute", distinct={"unique_orders": "order_id"}).orderBy(F.col("window_start").desc())


def business_metrics(gold_orders: DataFrame, as_of, hours: int = 24) -> DataFrame:
    recent = _since(gold_orders, "created_at", as_of, hours)
    counted = {"total_orders": "order_id", "unique_customers": "customer_id"}
    rows = windowed(recent, "created_at", "1 hour", "total_amount", counted)
    return rows.drop("records").withColumnsRenamed({"revenue": "total_revenue", "avg_value": "avg_order_value"}).orderBy(
        F.col("window_start").desc()
    )


def orders_per_minute(gold_orders: DataFrame, as_of, hours: int = 1) -> DataFrame:
    recent = _since(gold_orders, "created_at", as_of, hours)
    rows = windowed(recent, "created_at", "1 minute", "total_amount")
    return rows.select("window_start", F.col("records").alias("order_count"), "revenue").orderBy(F.col("window_start").desc())


def latency(landed: DataFrame, gold: DataFrame, key: str, as_of, hours: int = 1) -> DataFrame:
    """Seconds from event to landing and from landing to Gold."""
    recent = _since(landed, "ingested_at", as_of, hours)

    def stage(name: str, rows: DataFrame, start: str, end: str) -> DataFrame:
        seconds = boundary_diff("second", start, end)
        return rows.agg(
            (F.sum(seconds).cast("double") / F.count(seconds)).alias("avg_latency_sec"),
            F.min(seconds).alias("min_latency_sec"),
            F.max(seconds).alias("max_latency_sec"),
            F.count(F.lit(1)).alias("record_count"),
        ).withColumn("stage", F.lit(name))

    arrived = recent.where(F.col("kafka_timestamp").isNotNull())
    finished = recent.select(key, "ingested_at").join(gold.select(key, F.col("created_at").alias("_gold_at")), key)
    return stage("Event → Landing", arrived, "kafka_timestamp", "ingested_at").unionByName(
        stage("Landing → Gold", finished, "ingested_at", "_gold_at")
    )


def _count(rows: DataFrame, alias: str) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias(alias))


def flow(entities: Mapping[str, tuple[DataFrame, DataFrame, DataFrame]]) -> DataFrame:
    """Landed, Gold and pending rows per entity."""
    parts = []
    for name, (landed, gold, pending) in entities.items():
        for kind, rows in (("landed_count", landed), ("gold_count", gold), ("pending_count", pending)):
            parts.append(_count(rows, "n").select(F.lit(name).alias("entity"), F.lit(kind).alias("kind"), "n"))
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    wide = union.groupBy("entity").pivot("kind", ["landed_count", "gold_count", "pending_count"]).agg(F.sum("n"))
    done = F.col("gold_count").cast("double") / F.nullif(F.col("landed_count"), F.lit(0)) * 100
    return wide.select(
        "*", F.round(done, 2).alias("processing_pct"), (F.col("landed_count") - F.col("gold_count")).alias("not_processed")
    )


def pipeline_health(landed: DataFrame, pending: DataFrame, runs: DataFrame, as_of) -> DataFrame:
    """Component, status and details of the tables; running queries add ``jobs.progress``."""
    rows = F.count(F.lit(1))
    tables = landed.agg(
        F.when(rows > 0, "✓ Active").otherwise("✗ No Data").alias("status"),
        F.concat(F.lit("Last ingested: "), F.date_format(F.max("ingested_at"), "yyyy-MM-dd HH:mm:ss")).alias("details"),
    ).withColumn("component", F.lit("Landing Tables"))
    changes = pending.agg(
        F.when(rows > 0, "⚠ Pending Data").otherwise("✓ Up to Date").alias("status"),
        F.concat(rows.cast("string"), F.lit(" rows")).alias("details"),
    ).withColumn("component", F.lit("Change Stream"))
    limit = as_timestamp(as_of) - F.expr(f"INTERVAL {IDLE_MINUTES} MINUTES")
    jobs = runs.agg(
        F.when(F.max("executed_at") >= limit, "✓ Running").otherwise("✗ Stopped").alias("status"),
        F.concat(rows.cast("string"), F.lit(" runs")).alias("details"),
    ).withColumn("component", F.lit("Runs"))
    return tables.unionByName(changes).unionByName(jobs)


def run_status(runs: DataFrame, as_of, hours: int = 1) -> DataFrame:
    state = F.col("run_status")
    label = F.when(state == "FAILED", "✗ Failed").when(state == "SUCCESS", "✓ Success").otherwise(F.concat(F.lit("⚠ "), state))
    return _since(runs, "executed_at", as_of, hours).select(
        "ingest_run_id", "pipeline_name", "executed_at", "execution_duration_sec", label.alias("status")
    ).orderBy(F.col("executed_at").desc())


def run_failures(runs: DataFrame, as_of, hours: int = 24) -> DataFrame:
    failed = _since(runs, "executed_at", as_of, hours).where(F.col("run_status") == "FAILED")
    return failed.agg(
        F.lit("Task Failures").alias("error_type"), F.count(F.lit(1)).alias("error_count"), F.max("executed_at").alias("last_error")
    )


def backlog_alert(pending: DataFrame, limit: int = BACKLOG_LIMIT) -> DataFrame:
    rows = F.count(F.lit(1))
    alert = F.when(rows > limit, f"🚨 ALERT: Order stream backlog exceeds {limit} records").otherwise(OK)
    return pending.agg(alert.alias("alert_status"), rows.alias("current_backlog"))


def idle_alert(runs: DataFrame, as_of, minutes: int = IDLE_MINUTES) -> DataFrame:
    last = F.max("executed_at")
    limit = as_timestamp(as_of) - F.expr(f"INTERVAL {int(minutes)} MINUTES")
    alert = F.when(last < limit, f"🚨 ALERT: Tasks not executed in last {minutes} minutes").otherwise(OK)
    return runs.agg(alert.alias("alert_status"), last.alias("last_execution"))


def latency_alert(landed: DataFrame, as_of, hours: int = 1, minutes: int = LATENCY_MINUTES) -> DataFrame:
    recent = _since(landed, "ingested_at", as_of, hours).where(F.col("kafka_timestamp").isNotNull())
    waited = boundary_diff("minute", "kafka_timestamp", "ingested_at")
    average = F.sum(waited).cast("double") / F.nullif(F.count(waited), F.lit(0))
    alert = F.when(average > minutes, "🚨 ALERT: High latency detected").otherwise(OK)
    return recent.agg(alert.alias("alert_status"), average.alias("avg_latency_min"))


def landing_summary(landed: DataFrame, entity: str, keys: Mapping[str, str]) -> DataFrame:
    """Totals of one landing table; ``keys`` maps output names to the columns counted distinctly."""
    done = [F.count_if("processed_to_gold").alias("processed_count")] if "processed_to_gold" in landed.columns else []
    return landed.agg(
        F.lit(entity).alias("entity"), F.count(F.lit(1)).alias("total_records"),
        *[F.count_distinct(column).alias(alias) for alias, column in keys.items()],
        F.min("ingested_at").alias("first_record"), F.max("ingested_at").alias("last_record"), *done,
    )


def gold_order_summary(orders: DataFrame) -> DataFrame:
    return orders.agg(
        F.count(F.lit(1)).alias("total_orders"), F.count_distinct("order_id").alias("unique_orders"),
        F.count_distinct("customer_id").alias("unique_customers"), F.min("created_at").alias("first_order"),
        F.max("created_at").alias("last_order"),
    )


def gold_item_summary(items: DataFrame) -> DataFrame:
    return items.agg(
        F.count(F.lit(1)).alias("total_items"), F.count_distinct("order_id").alias("unique_orders"),
        F.sum("quantity").alias("total_quantity"), F.sum("subtotal").alias("total_amount"),
    )


def gold_delivery_summary(deliveries: DataFrame) -> DataFrame:
    return deliveries.agg(F.count(F.lit(1)).alias("total_deliveries"), F.count_distinct("order_id").alias("unique_orders"))


def status_distribution(rows: DataFrame, status: str, amount: str | None = None) -> DataFrame:
    extra = [F.sum(amount).alias("total_revenue")] if amount else []
    return rows.groupBy(F.col(status).alias("current_status")).agg(F.count(F.lit(1)).alias("row_count"), *extra).orderBy(
        F.col("row_count").desc()
    )


def layer_counts(layers: Mapping[str, DataFrame], key: str) -> DataFrame:
    union = None
    for name, rows in layers.items():
        part = rows.agg(F.lit(name).alias("layer"), F.count_distinct(key).alias("key_count"))
        union = part if union is None else union.unionByName(part)
    return union


def order_completeness(orders: DataFrame, items: DataFrame, deliveries: DataFrame, k: int | None = 10) -> DataFrame:
    """Orders with their item count and delivery, of all orders or the ``k`` rows with the highest ids.

    Every order gives at least one row, so those rows belong to the ``k`` highest
    orders; only their items and deliveries are read on (a broadcast of ``k`` ids).
    """
    orders = orders.select("order_id", "customer_id", "total_amount", "order_status")
    if k is not None:
        orders = orders.orderBy(F.col("order_id").desc()).limit(k)
        wanted = F.broadcast(orders.select("order_id"))
        items, deliveries = (part.join(wanted, "order_id", "left_semi") for part in (items, deliveries))
    counted = items.groupBy("order_id").agg(F.count_distinct("order_item_id").alias("item_count"))
    wide = (
        orders.join(counted, "order_id", "left")
        .join(deliveries.select("order_id", "delivery_id", "delivery_status", "delivery_agent_id"), "order_id", "left")
        .fillna(0, ["item_count"])
    )
    return wide if k is None else wide.orderBy(F.col("order_id").desc(), "delivery_id").limit(k)


def latest_changes(history: DataFrame, entity: str, k: int = 20) -> DataFrame:
    return history.orderBy(F.col("status_changed_at").desc(), entity).limit(k)


def orders_without_items(orders: DataFrame, items: DataFrame) -> DataFrame:
    missing = orders.join(items.select("order_id"), "order_id", "left_anti")
    return missing.select("order_id", "total_amount", F.lit(0).cast("long").alias("item_count"))


def orders_without_delivery(orders: DataFrame, deliveries: DataFrame) -> DataFrame:
    expected = orders.where(F.col("order_status") != "CANCELLED")
    return expected.join(deliveries.select("order_id"), "order_id", "left_anti").select("order_id", "order_status", "created_at")


def active_deliveries(deliveries: DataFrame) -> DataFrame:
    open_ones = deliveries.where(~F.col("delivery_status").isin("DELIVERED", "CANCELLED"))
    return open_ones.groupBy("delivery_status").agg(F.count(F.lit(1)).alias("delivery_count"))


def batch_summary(gold: DataFrame) -> DataFrame:
    return gold.groupBy("batch_id").agg(F.max("created_at").alias("last_created_at"), F.count(F.lit(1)).alias("row_count")).orderBy(
        F.col("last_created_at").desc()
    )

