"""Places in a global order, comparison of tables by content, and recovery of a failed run, with their checks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from silverlode.operators import content, position
from workbook.core import EVENT_AS_OF, case
from workbook.sources import NOW, csv_folder, medallion


@case("o1_order_positions", "SELECT order_id, cast(total_amount AS double) AS total_amount, row_number() OVER (ORDER BY total_amount DESC NULLS LAST, order_id) AS position FROM fact_order")
def _(t):
    """Every order's place by its amount."""
    return position.with_position(t["fact_order"].select("order_id", "total_amount"), ["total_amount desc", "order_id"])


@case(
    "o1_alert_positions",
    f"""SELECT alert_id, severity, detected_at, row_number() OVER (ORDER BY CASE severity WHEN 'CRITICAL' THEN 1 ELSE 2 END, detected_at DESC, alert_id) AS position
      FROM alerts WHERE alert_status = 'OPEN' AND detected_at <= TIMESTAMP '{EVENT_AS_OF}'""",
)
def _(t):
    """Open alerts as a list: severest first, then newest."""
    alerts = t["alerts"].where(F.col("alert_status") == "OPEN").select("alert_id", "severity", "detected_at")
    alerts = alerts.withColumn("_rank", F.when(F.col("severity") == "CRITICAL", 1).otherwise(2)).where(F.col("detected_at") <= F.lit(EVENT_AS_OF).cast("timestamp_ntz"))
    return position.with_position(alerts, ["_rank", "detected_at desc", "alert_id"]).drop("_rank")


@case("w3_global_dense_rank", "SELECT order_item_id, cast(quantity AS double) AS quantity, dense_rank() OVER (ORDER BY quantity DESC NULLS LAST) AS quantity_rank FROM fact_order_item")
def _(t):
    return position.with_dense_rank(t["fact_order_item"].select("order_item_id", "quantity"), ["quantity desc"], "quantity_rank")


COMPARED = ["order_id", "customer_id", "total_amount", "order_status"]


@case(
    "r8_content",
    """WITH a AS (SELECT order_id, customer_id, cast(total_amount AS double) AS total_amount, order_status FROM fact_order),
      b AS (SELECT order_id, CASE cast(order_id AS bigint) WHEN lo THEN hi_customer WHEN hi THEN lo_customer ELSE customer_id END AS customer_id,
          CASE WHEN cast(order_id AS bigint) % 211 = 0 THEN total_amount + 1 ELSE total_amount END AS total_amount, order_status
        FROM a, (SELECT min(cast(order_id AS bigint)) AS lo, max(cast(order_id AS bigint)) AS hi, arg_min(customer_id, cast(order_id AS bigint)) AS lo_customer, arg_max(customer_id, cast(order_id AS bigint)) AS hi_customer FROM a) e
        WHERE cast(order_id AS bigint) % 307 <> 0)
      SELECT a.order_id, 'SOURCE' AS side, CASE WHEN b.order_id IS NULL THEN 'MISSING_IN_TARGET' ELSE 'CHANGED' END AS status, cast(1 AS bigint) AS n FROM a LEFT JOIN b USING (order_id)
        WHERE b.order_id IS NULL OR a.total_amount <> b.total_amount OR a.customer_id <> b.customer_id
      UNION ALL SELECT b.order_id, 'TARGET', 'CHANGED', 1 FROM a JOIN b USING (order_id) WHERE a.total_amount <> b.total_amount OR a.customer_id <> b.customer_id""",
)
def _(t):
    """Orders against a copy with changed amounts, missing rows and the customers of two orders exchanged."""
    source = t["fact_order"].select(*COMPARED)
    number = F.col("order_id").cast("long")
    ends = source.agg(F.min(number).alias("lo"), F.max(number).alias("hi"), F.min_by("customer_id", number).alias("lo_customer"), F.max_by("customer_id", number).alias("hi_customer")).first()
    swapped = F.when(number == ends.lo, ends.hi_customer).when(number == ends.hi, ends.lo_customer).otherwise(F.col("customer_id"))
    changed = F.when(number % 211 == 0, (F.col("total_amount") + 1).cast("decimal(18,2)")).otherwise(F.col("total_amount"))
    target = source.where(number % 307 != 0).withColumns({"customer_id": swapped, "total_amount": changed})
    return content.differing_rows(source, target, ["order_id"], COMPARED)


@case(
    "r9_recovery",
    """SELECT order_id, 'TECHNICAL' AS error_type, 'PENDING' AS processing_status, cast(0 AS bigint) AS retry_count FROM fact_order
      UNION ALL SELECT NULL, alert_type, alert_status, cast(NULL AS bigint) FROM (SELECT 'FAILURE' AS alert_type, 'OPEN' AS alert_status) x""",
)
def _(t):
    """A run that must fail, as its restaurants are no numbers: each record becomes a letter, and there is one alert."""
    engine = medallion(t)
    broken = t.using()
    folder = csv_folder(broken, null="none")
    t.spark.read.option("header", True).csv(folder).withColumn("RESTAURANT_ID", F.lit("?")).write.option("header", True).mode("overwrite").csv(f"{folder}-broken")
    result = engine.run_with_recovery("ORDER_BATCH", "", f"{folder}-broken", now=datetime.fromisoformat(NOW), batch_id="BROKEN", strict=True)
    assert result.status == "FAILED"
    letters = engine.layer.read("dead_letter").select(F.get_json_object("record_data", "$.order_id").alias("order_id"), "error_type", "processing_status", "retry_count")
    alerts = engine.layer.read("alerts").select(F.lit(None).cast("string").alias("order_id"), F.col("alert_type").alias("error_type"), F.col("alert_status").alias("processing_status"), F.lit(None).cast("int").alias("retry_count"))
    return letters.unionByName(alerts)
