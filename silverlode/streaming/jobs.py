"""Streaming jobs: landing, the three-layer run per micro-batch, and windowed metrics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from silverlode.plans.medallion import DEAD_LETTERS, Medallion
from silverlode.streaming import events as ev

LATE = "10 minutes"


def _start(writer, every: str | None) -> StreamingQuery:
    """Run at an interval, or once over what has arrived."""
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def land(messages: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append messages to the landing table, partitioned by topic."""
    rows = ev.landed(messages)
    writer = rows.writeStream.format("parquet").partitionBy("topic").outputMode("append")
    return _start(writer.option("path", path).option("checkpointLocation", checkpoint), every)


def once_per_message(messages: DataFrame, late: str = LATE) -> DataFrame:
    """Drop repeated deliveries of a message; state is bounded by the watermark.

    Messages later than the watermark are dropped with it.  The run itself does not
    need this: a repeated message changes neither Silver nor Gold.
    """
    keyed = messages.withColumn("_id", F.sha2("value", 256)).withWatermark("kafka_timestamp", late)
    return keyed.dropDuplicatesWithinWatermark(["topic", "key", "_id"]).drop("_id")


def run_batches(medallion: Medallion, source_name: str, stream_name: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: bad messages to the dead letters, the rest through all layers.

    The batch id is the stream's name and the epoch.  An epoch that is delivered
    again finds its run logged as done, or republishes what it staged.
    """
    source = medallion.catalog.source(source_name)

    def run(batch: DataFrame, epoch: int) -> None:
        batch_id = f"STREAM_{stream_name}_{epoch}"
        batch = batch.persist()
        try:
            if batch.isEmpty() or medallion.finished(batch_id):
                return
            bad = ev.bad_events(batch, source.entity, source_name, batch_id)
            medallion.layer.replace_partitions(bad, f"stream_{DEAD_LETTERS}", ["batch_id"])
            rows = ev.text_rows(ev.typed_events(batch, source.entity), source.names)
            medallion.run_rows(source, lambda: rows, batch_id=batch_id)
        finally:
            batch.unpersist()

    return run


def stream_to_gold(
    medallion: Medallion, source_name: str, messages: DataFrame, checkpoint: str, stream_name: str, every: str | None = None,
    late: str | None = None,
) -> StreamingQuery:
    """Messages of one topic into Bronze, Silver and Gold, e.g. ``every='2 minutes'``.

    Late messages are kept, however late; ``late`` adds the bounded removal of repeats.
    """
    messages = once_per_message(messages, late) if late else messages
    writer = messages.writeStream.foreachBatch(run_batches(medallion, source_name, stream_name))
    return _start(writer.option("checkpointLocation", checkpoint).queryName(stream_name), every)


def windowed(
    rows: DataFrame, at: str, width: str, amount: str | None = None, distinct: dict[str, str] | None = None, late: str = LATE
) -> DataFrame:
    """Tumbling counts, sums and exact distinct counts, the same of a batch frame and of a stream.

    Distinct counts take two aggregations, one per window and value and one per window.  On a stream that is two stateful steps
    one after the other, whose state is bounded by the watermark; a window is given out once the watermark has passed it.
    """
    source = rows.withWatermark(at, late) if rows.isStreaming else rows
    distinct = distinct or {}
    money = rows.select(F.sum(amount).alias("s")).schema["s"].dataType if amount else None
    # a row for the counts and sums, and one for each column whose values are counted
    kinds = [F.struct(F.lit("").alias("of"), F.lit(None).cast("string").alias("value"))]
    kinds += [F.struct(F.lit(alias).alias("of"), F.col(column).cast("string").alias("value")) for alias, column in distinct.items()]
    source = source.withColumn("_kind", F.explode(F.array(*kinds))) if distinct else source.withColumn("_kind", kinds[0])
    own = F.col("_kind.of") == ""
    parts = [F.count_if(own).alias("_n")]
    if amount:
        parts += [F.sum(F.when(own, F.col(amount))).alias("_sum"), F.count(F.when(own, F.col(amount))).alias("_filled")]
    found = source.groupBy(F.window(at, width).alias("_w"), F.col("_kind.of").alias("_of"), F.col("_kind.value").alias("_value")).agg(*parts)
    measures = [F.sum("_n").alias("records")]
    if amount:
        total = F.sum("_sum").cast(money)
        measures += [total.alias("revenue"), (total.cast("double") / F.sum("_filled")).alias("avg_value")]
    measures += [F.count_if((F.col("_of") == alias) & F.col("_value").isNotNull()).alias(alias) for alias in distinct]
    again = F.window(F.window_time("_w"), width) if rows.isStreaming else F.col("_w")
    grouped = found.groupBy(again.alias("_w")).agg(*measures)
    return grouped.select(F.col("_w.start").alias("window_start"), *[c for c in grouped.columns if c != "_w"])


def windowed_to_table(
    rows: DataFrame, at: str, width: str, path: str, checkpoint: str, every: str | None = None, **measures
) -> StreamingQuery:
    """Append finished windows to a parquet table."""
    writer = windowed(rows, at, width, **measures).writeStream.outputMode("append").format("parquet")
    return _start(writer.option("path", path).option("checkpointLocation", checkpoint), every)


def progress(query: StreamingQuery) -> list[tuple[str, str, str]]:
    """Health rows of a running query: component, status, details."""
    state = "✓ Running" if query.isActive else "✗ Stopped"
    last = query.lastProgress
    detail = "no batch yet" if last is None else f"batch {last['batchId']}: {last['numInputRows']} rows"
    return [("Streaming query", state, f"{query.name}: {detail}")]
