"""Stream queries whose results are those of a batch over the same rows, with their checks.

Each writes rows of the driver tables as files and runs a stream over them until all have been read; a closing row moves
the watermark past them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.session import scratch_path
from silverlode.sources.driver_tables import STATUS_BY_EVENT, _choose
from silverlode.streaming import jobs, stateful
from workbook.core import case

#: Longer than the driver tables; the closing row comes later still.
EVER, CLOSED = "8000 days", 30000


def files_of(rows: DataFrame, at: str, key: str) -> str:
    """A folder with ``rows`` in files that are in no order of time, as many as their size asks for, and the closing row."""
    spark = rows.sparkSession
    folder = scratch_path(spark, "stream-files")
    rows.repartition(F.xxhash64(*rows.columns)).write.parquet(folder)
    # of what was written, so that the rows are worked out once
    stateful.closing(spark.read.schema(rows.schema).parquet(folder), at, key, -1, CLOSED).write.mode("append").parquet(folder)
    return folder


def stream_of(rows: DataFrame, at: str, key: str) -> DataFrame:
    folder = files_of(rows, at, key)
    return rows.sparkSession.readStream.schema(rows.schema).parquet(folder)


def run(stream: DataFrame, mode: str = "append") -> DataFrame:
    """What a stream gives out until its input is used up."""
    spark = stream.sparkSession
    root = scratch_path(spark, "stream")
    if mode == "append":
        writer = stream.writeStream.outputMode("append").format("parquet").option("path", f"{root}/table")
    else:
        writer = stream.writeStream.outputMode(mode).foreachBatch(lambda batch, epoch: batch.write.mode("append").parquet(f"{root}/table"))
    jobs._start(writer.option("checkpointLocation", f"{root}/checkpoint"), None).awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/table")


def statuses(t) -> DataFrame:
    return t["events"].select(F.col("user_id").alias("entity_id"), _choose(F.col("event_type"), STATUS_BY_EVENT).alias("status"), F.col("ts").cast("timestamp").alias("ts"), "event_id")


@case("u8_keyed_stream_history", "SELECT entity_id, old_status, new_status, status_changed_at FROM status_history")
def _(t):
    """Status changes by keyed state; events arrive in no order, and some of them twice."""
    events = statuses(t)
    repeated = events.unionByName(events.where(F.col("event_id") % 5 == 0))
    return run(stateful.status_history(stream_of(repeated, "ts", "entity_id"), "entity_id", "status", "ts", "event_id"))


@case(
    "u9_keyed_stream_state",
    """SELECT user_id, arg_max(event_type, ts) AS current_status, arg_min(event_type, ts) AS initial_status, max(ts) AS status_updated_at FROM events GROUP BY 1""",
)
def _(t):
    events = t["events"].select("user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), "event_id")
    moves = run(stateful.current_states(stream_of(events, "ts", "user_id"), "user_id", "event_type", "ts", "event_id"), "update")
    return stateful.last_states(moves, "user_id")


ORDERS = ("order_id", "customer_id", "total_amount", "order_status", "created_at")


@case("t14_stream_without_items", "SELECT o.order_id, cast(o.total_amount AS double) AS total_amount, cast(0 AS bigint) AS item_count FROM fact_order o WHERE NOT EXISTS (SELECT 1 FROM fact_order_item i WHERE o.order_id = i.order_id AND i.l_linenumber % 3 = 0)")
def _(t):
    """Orders none of whose third items arrived, before or after them."""
    orders = t["fact_order"].select(*ORDERS)
    items = t["fact_order_item"].where("l_linenumber % 3 = 0").select("order_id", F.col("ship_date").cast("timestamp_ntz").alias("ingested_at"))
    return run(
        stateful.orders_without_items(
            stream_of(orders, "created_at", "order_id"), stream_of(items, "ingested_at", "order_id"), "created_at", "ingested_at", EVER, before=EVER
        )
    )


@case("t14_stream_without_delivery", "SELECT o.order_id, o.order_status, o.created_at FROM fact_order o LEFT JOIN fact_delivery d ON o.order_id = d.order_id WHERE d.delivery_id IS NULL AND o.order_status NOT IN ('CANCELLED')")
def _(t):
    deliveries = t["fact_delivery"].select("order_id", F.col("delivery_date").alias("ingested_at"))
    missing = stateful.orders_without_delivery(
        stream_of(t["fact_order"].select(*ORDERS), "created_at", "order_id"), stream_of(deliveries, "ingested_at", "order_id"), "created_at", "ingested_at", EVER, before=EVER
    )
    return run(missing).select("order_id", "order_status", "created_at")


def windows(t, name: str, at: str, width: str, columns: list[str], **measures) -> DataFrame:
    rows = t[name].select(F.col(at).cast("timestamp").alias(at), *columns)
    return run(jobs.windowed(stream_of(rows, at, columns[0]), at, width, **measures))


@case("t1_stream_throughput", "SELECT date_trunc('minute', ingested_at) AS window_start, count(*) AS records, count(DISTINCT order_id) AS unique_orders FROM landed_order GROUP BY 1")
def _(t):
    return windows(t, "landed_order", "ingested_at", "1 minute", ["order_id"], distinct={"unique_orders": "order_id"})


@case(
    "t2_stream_business_metrics",
    """SELECT date_trunc('hour', created_at) AS window_start, count(*) AS records, cast(sum(total_amount) AS double) AS revenue, cast(sum(total_amount) AS double) / count(*) AS avg_value,
      count(DISTINCT order_id) AS total_orders, count(DISTINCT customer_id) AS unique_customers FROM gold_order GROUP BY 1""",
)
def _(t):
    counted = {"total_orders": "order_id", "unique_customers": "customer_id"}
    return windows(t, "gold_order", "created_at", "1 hour", ["order_id", "customer_id", "total_amount"], amount="total_amount", distinct=counted)
