"""Status histories and current-state facts from event sequences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.operators.sequence import lag, with_features


def transitions(
    events: DataFrame,
    entity: str,
    status: str,
    changed_at: str,
    ties: Sequence[str] = (),
    last_known: str | DataFrame | None = None,
) -> DataFrame:
    """One row per status change: entity, old_status, new_status, status_changed_at.

    ``last_known`` (entity, status) seeds the old status of each entity's first event; it may be a column that the events carry.
    An entity is an order or a delivery, whose events are the few steps of its life: a plain window holds them.
    """
    sequence = with_features(events, [entity], [changed_at, *ties], [lag("_old", status), lag("_seen", changed_at)], bounded=True)
    if last_known is not None:
        known = last_known
        if not isinstance(known, str):
            known = "_known"
            sequence = sequence.join(last_known.select(entity, F.col(status).alias(known)), entity, "left")
        sequence = sequence.withColumn("_old", F.when(F.col("_seen").isNull(), F.col(known)).otherwise(F.col("_old")))
    changed = F.col("_old").isNull() | (F.col("_old") != F.col(status))
    return sequence.where(changed).select(
        entity,
        F.col("_old").alias("old_status"),
        F.col(status).alias("new_status"),
        F.col(changed_at).alias("status_changed_at"),
    )


def current_state(events: DataFrame, entity: str, status: str, changed_at: str, ties: Sequence[str] = ()) -> DataFrame:
    """First and last status per entity, and when the last one was set."""
    when = F.struct(changed_at, *ties)
    return events.groupBy(entity).agg(
        F.max_by(status, when).alias("current_status"),
        F.min_by(status, when).alias("initial_status"),
        F.max(changed_at).alias("status_updated_at"),
    )
