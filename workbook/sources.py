"""Readers, writers, runs and streams over data that Spark writes from the driver tables."""

from __future__ import annotations

from collections import ChainMap

from pyspark.sql import functions as F

from silverlode.catalog import CSV_COMMA, CSV_PIPE, DEFAULT, JSON_ARRAY
from silverlode.plans import delivery_marts
from silverlode.plans.medallion import Medallion
from silverlode.plans.views import LayerTables
from silverlode.session import discard, scratch_path
from silverlode.sources import files
from silverlode.streaming import events as ev
from silverlode.streaming import jobs
from workbook.core import case
from workbook.delivery import AGENT_SQL

ORDER = DEFAULT.source("ORDER_BATCH")


def order_texts(t):
    """Orders as the text rows of their file."""
    return t["fact_order"].select(*[F.col(n).cast("string") for n in ORDER.names])


def csv_folder(t, sep: str = ",", null: str = "\\N") -> str:
    path = scratch_path(t.spark, "orders-csv")
    order_texts(t).write.option("header", True).option("sep", sep).option("nullValue", null).csv(path)
    return path


TEXTS = """SELECT order_id, customer_id, cast(restaurant_id AS varchar) AS restaurant_id, strftime(order_date, '%Y-%m-%d %H:%M:%S') AS order_date, cast(total_amount AS varchar) AS total_amount,
  order_status, payment_method FROM fact_order"""


@case("s1_csv_scan", TEXTS)
def _(t):
    return files.read_delimited(t.spark, csv_folder(t), ORDER.names, CSV_COMMA)


@case("s2_pipe_scan", TEXTS)
def _(t):
    return files.read_delimited(t.spark, csv_folder(t, "|", "NULL"), ORDER.names, CSV_PIPE)


@case("s3_json_scan", TEXTS)
def _(t):
    path = scratch_path(t.spark, "orders-json")
    filled = order_texts(t).fillna("NULL", ["restaurant_id"])
    filled.select(F.concat(F.lit("["), F.to_json(F.struct(*ORDER.names)), F.lit("]"))).write.text(path)
    return files.read_json(t.spark, path, files.text_schema(ORDER.names), JSON_ARRAY)


@case("s4_parquet_scan", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_totalprice > 100000")
def _(t):
    return files.read_parquet(t.spark, t.folder, "orders.parquet").where("o_totalprice > 100000").select("o_orderkey", "o_custkey", "o_orderstatus")


@case("s5_csv_to_parquet", TEXTS)
def _(t):
    target = scratch_path(t.spark, "orders-parquet")
    files.csv_to_parquet(t.spark, csv_folder(t), target, ORDER.names)
    return t.spark.read.parquet(target)


@case("s6_discovery", "SELECT 'csv' AS kind, count(*) AS row_count FROM orders UNION ALL SELECT 'json', count(*) FROM events")
def _(t):
    """Files of two kinds in one tree, told apart by their name pattern."""
    root = scratch_path(t.spark, "mixed")
    order_texts(t).write.option("header", True).csv(f"{root}/a")
    t["events"].write.json(f"{root}/b")
    rows = files.with_file_name(files.read_delimited(t.spark, root, ORDER.names, CSV_COMMA, "*.csv"))
    lines = t.spark.read.option("pathGlobFilter", "*.json").option("recursiveFileLookup", True).text(root)
    return rows.where(F.col("source_file").endswith(".csv")).agg(F.lit("csv").alias("kind"), F.count(F.lit(1)).alias("row_count")).unionByName(
        lines.agg(F.lit("json").alias("kind"), F.count(F.lit(1)).alias("row_count"))
    )


def message_folder(t, rows) -> str:
    """Messages as JSON lines, like a broker's backlog."""
    path = scratch_path(t.spark, "messages")
    rows.select("topic", "partition", "offset", F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp_ms"), "key", "value").write.json(path)
    return path


def order_messages(t):
    """Each user is an order; each event sets its status."""
    from silverlode.sources.driver_tables import STATUS_BY_EVENT, _choose

    status = _choose(F.col("event_type"), STATUS_BY_EVENT)
    body = F.struct(
        F.lit("ORDER_UPDATED").alias("event_type"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("event_timestamp"),
        F.concat(F.lit("ORD"), F.col("user_id").cast("string")).alias("order_id"), F.col("user_id").cast("string").alias("customer_id"),
        (F.col("user_id") % 10).alias("restaurant_id"), F.lit("2024-01-01T00:00:00").alias("order_date"), F.col("value").cast("decimal(10,2)").alias("total_amount"),
        status.alias("order_status"), F.lit("UPI").alias("payment_method"),
    )
    return t["events"].select(
        F.lit("orders-events").alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"), "ts",
        F.col("user_id").cast("string").alias("key"), F.to_json(body).alias("value"),
    )


def landed(t, folder: str):
    root = scratch_path(t.spark, "landing")
    for _ in range(2):
        # The second run finds nothing new: the checkpoint holds what was read.
        jobs.land(ev.file_messages(t.spark, folder), f"{root}/table", f"{root}/checkpoint").awaitTermination()
    return t.spark.read.parquet(f"{root}/table")


@case("s7_event_source", "SELECT 'orders-events' AS topic, event_id AS message_offset, cast(user_id AS varchar) AS key, ts AS kafka_timestamp FROM (SELECT event_id, user_id, date_trunc('millisecond', ts) AS ts FROM events) x")
def _(t):
    rows = ev.file_messages(t.spark, message_folder(t, order_messages(t)), stream=False)
    return rows.select("topic", F.col("offset").alias("message_offset"), "key", "kafka_timestamp")


@case("s8_landing", "SELECT 'orders-events' AS topic, event_id AS message_offset, cast(user_id AS varchar) AS key, cast(json_valid(props) AS boolean) AS has_payload FROM events")
def _(t):
    rows = landed(t, message_folder(t, order_messages(t)))
    return rows.select("topic", F.col("offset").alias("message_offset"), "key", F.try_parse_json("value").isNotNull().alias("has_payload"))


@case("s10_change_read", "SELECT count(*) AS row_count, count(DISTINCT event_id) AS messages FROM events")
def _(t):
    return landed(t, message_folder(t, order_messages(t))).agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct("offset").alias("messages"))


@case(
    "s11_stream_windows",
    """SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, count(*) AS records, cast(sum(cast(value AS decimal(10,2))) AS double) AS revenue FROM events
       GROUP BY 1 HAVING time_bucket(INTERVAL '1 hour', min(ts)) + INTERVAL '1 hour' <= (SELECT max(date_trunc('millisecond', ts)) FROM events) - INTERVAL '10 minutes'""",
)
def _(t):
    """Finished hours of a stream; the last ones stay open until the watermark has passed them."""
    root = scratch_path(t.spark, "windows")
    messages = ev.file_messages(t.spark, message_folder(t, order_messages(t)), files_per_batch=1000)
    amount = F.try_variant_get(F.try_parse_json("value"), "$.total_amount", "decimal(10,2)")
    jobs.windowed_to_table(
        messages.withColumn("total_amount", amount), "kafka_timestamp", "1 hour", f"{root}/table", f"{root}/checkpoint", amount="total_amount"
    ).awaitTermination()
    return t.spark.read.parquet(f"{root}/table").select("window_start", "records", "revenue")


def medallion(t) -> Medallion:
    return Medallion(t.spark, scratch_path(t.spark, "layers"), DEFAULT, buckets=4)


NOW = "2001-08-01 00:00:00"
GOOD = "FROM fact_order WHERE restaurant_id IS NOT NULL"


def loaded_orders(t) -> Medallion:
    from datetime import datetime

    engine = medallion(t)
    engine.run_files("ORDER_BATCH", "", csv_folder(t), now=datetime.fromisoformat(NOW), batch_id="BATCH_1")
    return engine


@case(
    "r12_files_to_gold",
    f"""SELECT order_id, customer_id, restaurant_id, order_date, cast(total_amount AS double) AS total_amount, order_status, payment_method, 'ACTIVE' AS status, TIMESTAMP '{NOW}' AS eff_start_dt,
      TIMESTAMP '9999-12-31 23:59:59' AS eff_end_dt, 'BATCH_1' AS batch_id {GOOD}""",
)
def _(t):
    return loaded_orders(t).layer.read("fact_order").select(*ORDER.names, "status", "eff_start_dt", "eff_end_dt", "batch_id")


@case("s12_bronze", f"""SELECT order_id, order_id AS order_id_raw, strftime(order_date, '%Y-%m-%d %H:%M:%S') AS order_date_raw, order_date, cast(1 AS bigint) AS ingest_run_id, TIMESTAMP '{NOW}' AS created_at FROM fact_order""")
def _(t):
    rows = loaded_orders(t).layer.read("order_brz")
    return rows.select("order_id", "order_id_raw", "order_date_raw", "order_date", "ingest_run_id", "created_at")


@case("s13_silver", f"SELECT order_id, customer_id, order_status, 'BATCH_1' AS batch_id, TIMESTAMP '{NOW}' AS created_at, TIMESTAMP '{NOW}' AS updated_at {GOOD}")
def _(t):
    return loaded_orders(t).layer.read("order_slv").select("order_id", "customer_id", "order_status", "batch_id", "created_at", "updated_at")


@case("s14_error_and_run_log", """SELECT 'ORDER_BATCH' AS pipeline_name, 'SUCCESS' AS run_status, count(*) AS source_row_count, count(restaurant_id) AS valid_row_count, count(*) - count(restaurant_id) AS invalid_row_count,
  count(*) - count(restaurant_id) AS error_rows FROM fact_order""")
def _(t):
    engine = loaded_orders(t)
    errors = engine.layer.read("order_load_error").agg(F.count(F.lit(1)))
    return engine.runs().select("pipeline_name", "run_status", "source_row_count", "valid_row_count", "invalid_row_count", errors.scalar().alias("error_rows"))


def streamed_orders(t) -> Medallion:
    engine = medallion(t)
    messages = ev.file_messages(t.spark, message_folder(t, order_messages(t)), files_per_batch=1000)
    jobs.stream_to_gold(engine, "ORDER_STREAM", messages, scratch_path(t.spark, "checkpoint"), "orders").awaitTermination()
    return engine


@case(
    "r12_stream_to_gold",
    """SELECT concat('ORD', cast(user_id AS varchar)) AS order_id, cast(user_id AS varchar) AS customer_id, arg_max(status, ts) AS order_status, cast(arg_max(cast(value AS decimal(10,2)), ts) AS double) AS total_amount
       FROM (SELECT *, CASE event_type WHEN 'click' THEN 'PENDING' WHEN 'view' THEN 'CONFIRMED' WHEN 'signup' THEN 'PREPARING' WHEN 'purchase' THEN 'READY' WHEN 'error' THEN 'OUT_FOR_DELIVERY' END AS status FROM events) e GROUP BY user_id""",
)
def _(t):
    gold = streamed_orders(t).layer.read("fact_order").where(F.col("status") == "ACTIVE")
    return gold.select("order_id", "customer_id", "order_status", "total_amount")


@case("u8_stream_history", "SELECT concat('ORD', cast(entity_id AS varchar)) AS order_id, old_status, new_status, status_changed_at FROM status_history")
def _(t):
    return streamed_orders(t).layer.read("fact_order_status_history").select("order_id", "old_status", "new_status", "status_changed_at")


def landing_file(texts, path: str) -> None:
    """Packed files of a bounded number of rows each, as a packed file is read by one task."""
    texts.write.option("header", True).option("nullValue", "\\N").option("compression", "gzip").option("maxRecordsPerFile", 1_000_000).csv(path)


def delivered_twice(t) -> Medallion:
    """Deliveries from two files: all assigned, then as they ended, in the sources' own spelling."""
    from datetime import datetime

    engine = medallion(t)
    names = DEFAULT.source("DELIVERY_BATCH").names
    ended = F.initcap(F.replace("delivery_status", F.lit("_"), F.lit(" ")))
    for day, status in enumerate((F.lit("assigned"), ended), 1):
        path = scratch_path(t.spark, "deliveries-csv")
        texts = t["fact_delivery"].withColumn("delivery_status", status).select(*[F.col(n).cast("string") for n in names])
        landing_file(texts, path)
        engine.run_files("DELIVERY_BATCH", "", path, now=datetime(2001, 8, day), batch_id=f"BATCH_{day}")
        discard(t.spark, path)  # all of it is in Bronze
    return engine


def _over_layers(t) -> ChainMap:
    """The driver's tables, with deliveries and their history as a run has written them."""
    written = LayerTables(delivered_twice(t).layer)
    return ChainMap({name: written[name] for name in ("fact_delivery", "delivery_history")}, t)


@case("e2e_m5_delivery_agent_performance", AGENT_SQL)
def _(t):
    return delivery_marts.delivery_agent_performance(_over_layers(t))


@case(
    "e2e_m7_delivery_status_transitions",
    """SELECT delivery_id, old_status, new_status FROM (
         SELECT delivery_id, NULL AS old_status, 'ASSIGNED' AS new_status FROM fact_delivery
         UNION ALL SELECT delivery_id, 'ASSIGNED', delivery_status FROM fact_delivery) x""",
)
def _(t):
    return delivery_marts.delivery_status_transitions(_over_layers(t)).select("delivery_id", "old_status", "new_status")
