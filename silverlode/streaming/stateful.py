"""Keyed state on streams: status histories, current states, and rows that stay without a partner.

``status_history`` and ``current_states`` keep each key's state with ``transformWithState``.  Events wait in the state until
the watermark has passed them and are then worked off in event order, so that the result does not depend on the order of
arrival: it is that of ``operators.history`` over the same events.  An event that is delivered again while it waits
counts once.  ``forget`` bounds the state: a key that has been quiet for so long is dropped, and starts anew if it returns.

``unmatched`` is a stream-stream left outer join: a row is given out once the watermark says that its partner can't come any more.

Events later than the watermark are dropped by Spark before they reach any of these; pick ``late`` accordingly, or keep
the micro-batch run (``jobs.stream_to_gold``), which keeps late events however late.  State of a key lies in one task; it is the
statuses of one order or delivery.  State lives in RocksDB below the query's checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
TRANSITION = "old_status string, new_status string, status_changed_at timestamp"
STATE = "current_status string, initial_status string, status_updated_at timestamp, event_number long"


def use_rocksdb(spark: SparkSession) -> None:
    """Queries that are started from now on keep their state in RocksDB, which keyed processors need."""
    spark.conf.set(_PROVIDER, ROCKSDB)


class _Statuses(StatefulProcessor):
    """Waiting events of a key, and what the last one that was worked off left behind."""

    def __init__(self, states: bool, forget_ms: int | None):
        self.states, self.forget_ms = states, forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.current = handle.getValueState("current", "status string, at long, initial string, number long")
        self.waiting = handle.getListState("waiting", "at long, tie long, status string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803 - names of the interface
        """Puts by a key's events of a batch with one call of the state; every call is a message to another process."""
        came = list({(row.at, row.tie, row.status) for row in rows})
        if came:
            self.waiting.appendList(came)
            self.handle.registerTimer(-(-min(e[0] for e in came) // 1000))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        """Works off all events that the watermark has passed; no earlier one can come any more."""
        until = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = {tuple(e) for e in self.waiting.get()} if self.waiting.exists() else set()
        due = sorted((e for e in waiting if e[0] <= until), key=lambda e: (e[0], e[1], e[2] is not None, e[2]))
        later = [e for e in waiting if e[0] > until]
        found = self.current.get() if self.current.exists() else None
        status, last, initial, number = tuple(found) if found else (None, None, None, 0)
        out = []
        for at, tie, new in due:
            if not self.states and (number == 0 or status is None or (new is not None and status != new)):
                out.append(Row(entity=key[0], old_status=status, new_status=new, status_changed_at=at))
            initial = new if number == 0 else initial
            status, last, number = new, at, number + 1
        if due:
            self.current.update((status, last, initial, number))
            if self.states:
                out.append(Row(entity=key[0], current_status=status, initial_status=initial, status_updated_at=last, event_number=number))
        if later:
            if due:
                self.waiting.put(later)
            self.handle.registerTimer(-(-min(e[0] for e in later) // 1000))
            return iter(out)
        if due:
            self.waiting.clear()
        if self.forget_ms is not None and last is not None:
            if last + self.forget_ms * 1000 <= until:
                self.current.clear()
            else:
                self.handle.registerTimer(-(-last // 1000) + self.forget_ms)
        return iter(out)


def _keyed(events: DataFrame, entity: str, status: str, changed_at: str, tie: str | None, late: str, forget: timedelta | None, states: bool) -> DataFrame:
    use_rocksdb(events.sparkSession)
    kind = events.schema[entity].dataType
    rows = events.where(F.col(changed_at).isNotNull()).select(
        F.col(entity).alias("entity"), F.col(status).cast("string").alias("status"), F.col(changed_at).cast("timestamp").alias("_at"),
        (F.col(tie).cast("long") if tie else F.lit(0).cast("long")).alias("tie"),
    )
    rows = rows.withWatermark("_at", late).withColumn("at", F.unix_micros("_at"))
    out = T.StructType([T.StructField("entity", kind), *T._parse_datatype_string((STATE if states else TRANSITION).replace("timestamp", "long")).fields])
    processor = _Statuses(states, int(forget.total_seconds() * 1000) if forget is not None else None)
    found = rows.groupBy("entity").transformWithState(processor, out, "Update" if states else "Append", "EventTime")
    at = "status_updated_at" if states else "status_changed_at"
    return found.withColumn(at, F.timestamp_micros(at)).withColumnRenamed("entity", entity)


def status_history(
    events: DataFrame, entity: str, status: str, changed_at: str, tie: str | None = None, late: str = "10 minutes", forget: timedelta | None = None
) -> DataFrame:
    """``operators.history.transitions`` of a stream: one row per status change, once the watermark has passed it.

    Events of one moment are ordered by ``tie`` (whole numbers), then by status.  Events without a time are left out.
    """
    return _keyed(events, entity, status, changed_at, tie, late, forget, states=False)


def current_states(
    events: DataFrame, entity: str, status: str, changed_at: str, tie: str | None = None, late: str = "10 minutes", forget: timedelta | None = None
) -> DataFrame:
    """``operators.history.current_state`` of a stream: a row per key whenever it moves on; ``event_number`` orders a key's rows."""
    return _keyed(events, entity, status, changed_at, tie, late, forget, states=True)


def last_states(rows: DataFrame, entity: str) -> DataFrame:
    """The state of each key out of the rows that ``current_states`` has written."""
    names = [c for c in rows.columns if c not in (entity, "event_number")]
    last = rows.groupBy(entity).agg(F.max_by(F.struct(*names), "event_number").alias("last"))
    return last.select(entity, *[F.col(f"last.{c}").alias(c) for c in names])


def unmatched(rows: DataFrame, partners: DataFrame, key: str, rows_at: str, partners_at: str, within: str, late: str = "10 minutes", before: str = "0 seconds", only: Column | None = None) -> DataFrame:
    """Rows of a stream without a row of ``partners`` from ``before`` ahead of them up to ``within`` after them.

    A row is given out when the watermark of both streams has passed its deadline.  Rows
    where ``only`` does not hold are left out, but move the watermark like any other.
    """
    left = rows.withColumn("_left_at", F.col(rows_at).cast("timestamp")).withWatermark("_left_at", late)
    right = partners.select(F.col(key).alias("_key"), F.col(partners_at).cast("timestamp").alias("_right_at")).withWatermark("_right_at", late)
    met = left.join(
        right,
        (F.col(key) == F.col("_key"))
        & (F.col("_right_at") >= F.col("_left_at") - F.expr(f"INTERVAL {before}"))
        & (F.col("_right_at") <= F.col("_left_at") + F.expr(f"INTERVAL {within}")),
        "leftOuter",
    )
    # one condition on both sides, which is not moved below the join and the watermark
    alone = F.when(F.col("_key").isNull(), F.lit(True) if only is None else only)
    return met.where(F.coalesce(alone, F.lit(False))).drop("_left_at", "_key", "_right_at")


def orders_without_items(orders: DataFrame, items: DataFrame, orders_at: str, items_at: str, within: str, **options: str) -> DataFrame:
    """Orders of a stream none of whose items arrived in time."""
    missing = unmatched(orders, items, "order_id", orders_at, items_at, within, **options)
    return missing.select("order_id", "total_amount", F.lit(0).cast("long").alias("item_count"))


def orders_without_delivery(orders: DataFrame, deliveries: DataFrame, orders_at: str, deliveries_at: str, within: str, **options: str) -> DataFrame:
    """Orders of a stream that were not cancelled and got no delivery in time."""
    return unmatched(orders, deliveries, "order_id", orders_at, deliveries_at, within, only=F.col("order_status") != "CANCELLED", **options)


def closing(rows: DataFrame, at: str, key: str, value: object, days: int = 3650) -> DataFrame:
    """A last row far behind all of ``rows`` (a batch frame): it moves the watermark past a finite input.

    Its key is ``value``, which no row may have; joins would leave out a row without a key before it counts.
    """
    end = rows.agg((F.max(F.col(at).cast("timestamp")) + F.expr(f"INTERVAL {int(days)} DAYS")).cast(rows.schema[at].dataType).alias(at))
    others = [F.col(f.name) if f.name == at else F.lit(value if f.name == key else None).cast(f.dataType).alias(f.name) for f in rows.schema]
    return end.select(*others).where(F.col(at).isNotNull())
