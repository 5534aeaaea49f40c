"""Event sources: landing rows, typed views per topic, and bad events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Topics, and per topic the payload fields as (name, type, other spelling).
TOPICS = {"order": "orders-events", "order_item": "order-items-events", "delivery": "delivery-events"}
FIELDS = {
    "order": [
        ("order_id", "string"), ("customer_id", "string"), ("restaurant_id", "bigint"), ("order_date", "timestamp"),
        ("total_amount", "decimal(10,2)"), ("order_status", "string", "status"), ("payment_method", "string"),
    ],
    "order_item": [
        ("order_item_id", "string"), ("order_id", "string"), ("menu_id", "bigint"), ("quantity", "int"),
        ("price", "decimal(10,2)"), ("subtotal", "decimal(10,2)"),
    ],
    "delivery": [
        ("delivery_id", "string"), ("order_id", "string"), ("delivery_agent_id", "bigint"), ("delivery_status", "string"),
        ("estimated_time", "string"), ("customer_address_id", "bigint"), ("delivery_date", "timestamp"),
    ],
}

# What a message looks like when it comes from JSON-lines files instead of a broker.
FILE_MESSAGE = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp_ms", T.LongType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)
_METADATA = ["topic", "partition", "offset", "kafka_timestamp", "key", "value"]


def kafka_messages(spark: SparkSession, servers: str, topics: list[str], per_batch: int | None = None) -> DataFrame:
    """Messages from a broker; needs the Kafka connector on the class path.  ``per_batch`` limits the rate, if given."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "earliest")
        .options(**({"maxOffsetsPerTrigger": per_batch} if per_batch else {}))
        .load()
    )
    return raw.select(
        "topic", "partition", "offset", F.col("timestamp").alias("kafka_timestamp"),
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
    )


def file_messages(spark: SparkSession, path: str, files_per_batch: int | None = None, stream: bool = True) -> DataFrame:
    """The same messages from JSON-lines files.  A line that is no message keeps its text as value."""
    schema = T.StructType([*FILE_MESSAGE.fields, T.StructField("_corrupt_record", T.StringType())])
    reader = spark.readStream.options(**({"maxFilesPerTrigger": files_per_batch} if files_per_batch else {})) if stream else spark.read
    raw = reader.schema(schema).option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
    sent = F.coalesce(F.timestamp_millis("timestamp_ms"), F.current_timestamp())
    return raw.select(
        "topic", "partition", "offset", sent.alias("kafka_timestamp"), "key",
        F.coalesce("value", "_corrupt_record").alias("value"),
    )


def landed(messages: DataFrame) -> DataFrame:
    """Landing rows: metadata beside the untouched payload, which malformed messages keep too."""
    return messages.select(*_METADATA, F.current_timestamp().alias("ingested_at"))


def field(name: str, kind: str, *others: str) -> Column:
    """A payload field under any of its names, in lower or upper case; NULL if it does not convert."""
    tries = []
    for spelling in (name, *others):
        for text in (spelling, spelling.upper()):
            tries.append(F.try_variant_get("payload", f"$.{text}", kind))
    return F.coalesce(*tries)


def typed_events(messages: DataFrame, entity: str) -> DataFrame:
    """One topic's messages as columns.  Rows without payload or key are left to ``bad_events``."""
    name = FIELDS[entity][0][0]
    parsed = messages.where(F.col("topic") == TOPICS[entity]).withColumn("payload", F.try_parse_json("value"))
    columns = [field(n, k, *o).alias(n) for n, k, *o in FIELDS[entity]]
    extra = [field("location", "string").alias("location")] if entity == "delivery" else []
    kept = [c for c in ("ingested_at",) if c in messages.columns]
    return parsed.select(
        F.col("offset").alias("kafka_offset"), F.col("partition").alias("kafka_partition"), "kafka_timestamp",
        field("event_type", "string").alias("event_type"),
        field("event_timestamp", "timestamp").alias("event_timestamp"),
        *columns, *extra, *kept,
    ).where(F.col(name).isNotNull())


def is_bad(entity: str) -> Column:
    """No JSON, or no key: such a message goes to the dead letters and does not stop the stream."""
    name = FIELDS[entity][0][0]
    payload = F.try_parse_json("value")
    found = F.coalesce(
        F.try_variant_get(payload, f"$.{name}", "string"), F.try_variant_get(payload, f"$.{name.upper()}", "string")
    )
    return found.isNull()


def bad_events(messages: DataFrame, entity: str, worker: str, batch_id: str | None = None) -> DataFrame:
    """Messages without payload or key.  With ``batch_id`` they are letters that a retry can read and settle, named by batch, partition and offset."""
    topic = F.col("topic")
    mine = topic.isNull() | (topic == TOPICS[entity])
    place = [F.coalesce(F.col(c).cast("string"), F.lit("none")) for c in ("partition", "offset")]
    letter = [] if batch_id is None else [
        F.concat_ws("-", F.lit(batch_id), *place).alias("dlq_id"), F.col("kafka_timestamp").cast("timestamp_ntz").alias("created_at"),
        F.lit(None).cast("timestamp_ntz").alias("last_retry_at"), F.lit(batch_id).alias("batch_id"),
    ]
    return messages.where(mine & is_bad(entity)).select(
        *letter,
        F.lit(worker).alias("pipeline_name"), F.coalesce(topic, F.lit("unknown")).alias("source_table"),
        F.col("value").alias("record_data"), F.lit("TRANSFORMATION").alias("error_type"),
        F.lit("message has no valid payload").alias("error_message"), F.lit(0).alias("retry_count"),
        F.lit("PENDING").alias("processing_status"),
    )


def text_rows(events: DataFrame, names: list[str]) -> DataFrame:
    """Typed events as the text rows a run starts from, with their event time."""
    return events.select(
        *[F.col(n).cast("string") if n in events.columns else F.lit(None).cast("string").alias(n) for n in names],
        F.coalesce("event_timestamp", "kafka_timestamp").alias("event_ts"),
    )


def newest(messages: DataFrame, k: int) -> DataFrame:
    """The latest messages by the time inside their payload."""
    at = F.try_variant_get(F.try_parse_json("value"), "$.event_timestamp", "timestamp_ntz")
    return messages.withColumn("event_timestamp", at).orderBy(F.col("event_timestamp").desc_nulls_last(), "offset").limit(k)
