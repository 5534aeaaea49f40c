"""Versioned (type 2) tables: change detection, expiry and new versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.functions.scalar import boundary_diff, plain_columns, row_hash, texts_differ
from silverlode.operators.merge import stored_for

# Fixed value: end of an open version.
OPEN_END = "9999-12-31 23:59:59"


def detect_changes(active: DataFrame, batch: DataFrame, keys: Sequence[str], tracked: Sequence[str]) -> DataFrame:
    """Batch rows with ``row_hash`` and ``scd_action`` (INSERT, UPDATE, UNCHANGED).

    Compares with the active versions only, and with the hash stored there.
    """
    hashed = batch.withColumn("row_hash", row_hash(list(tracked)))
    stored = stored_for(active, batch, keys, ["row_hash"]).withColumnRenamed("row_hash", "_stored")
    action = (
        F.when(F.col("_stored").isNull(), "INSERT")
        .when(F.col("_stored") != F.col("row_hash"), "UPDATE")
        .otherwise("UNCHANGED")
    )
    return hashed.join(stored, list(keys), "left").withColumn("scd_action", action).drop("_stored")


def apply_changes(
    active: DataFrame, staged: DataFrame, keys: Sequence[str], *, batch_id: str, now: Column
) -> DataFrame:
    """Active rows after the batch plus the rows it expires, told apart by ``status``.

    ``active`` holds the open versions; expired history is never read or rewritten.
    """
    keys = list(keys)
    changed = staged.where(F.col("scd_action") == "UPDATE").select(*keys, F.lit(True).alias("_changed"))
    hit = F.coalesce(F.col("_changed"), F.lit(False))
    old = (
        active.join(changed, keys, "left")
        .withColumn("status", F.when(hit, "INACTIVE").otherwise(F.col("status")))
        .withColumn("eff_end_dt", F.when(hit, now).otherwise(F.col("eff_end_dt")))
        .withColumn("updated_at", F.when(hit, now).otherwise(F.col("updated_at")))
        .select(*active.columns)
    )
    new = new_versions(staged, batch_id=batch_id, now=now).select(*active.columns)
    return old.unionByName(new)


def pack_hash(df: DataFrame, tracked: Sequence[str]) -> DataFrame:
    """``row_hash`` as its bytes, and only where it is not that of the row's own values: no codec makes a hash smaller."""
    own = F.col("row_hash") == row_hash(list(tracked), plain=plain_columns(df.schema))
    return df.withColumn("row_hash", F.when(own, None).otherwise(F.unhex("row_hash")))


def unpack_hash(df: DataFrame, tracked: Sequence[str]) -> DataFrame:
    """``row_hash`` as text again; that of a row which carries none is worked out."""
    return df.withColumn("row_hash", F.coalesce(F.lower(F.hex("row_hash")), row_hash(list(tracked), plain=plain_columns(df.schema))))


def versions_after(
    active: DataFrame, batch: DataFrame, keys: Sequence[str], tracked: Sequence[str], *, batch_id: str, now: Column
) -> DataFrame:
    """``apply_changes`` of ``detect_changes`` in one join that moves each side once; both hold one row per key.

    ``row_hash`` comes back packed, and NULL for new versions: ``unpack_hash`` it where the rows are stored.
    """
    keys, columns = list(keys), active.columns
    stored = pack_hash(active, tracked).select(*keys, F.struct(*[c for c in columns if c not in keys]).alias("_old"))
    opened = new_versions(
        batch.withColumns({"row_hash": F.lit(None).cast("binary"), "scd_action": F.lit("INSERT")}), batch_id=batch_id, now=now
    ).select(*keys, F.struct(*[c for c in columns if c not in keys]).alias("_new"))
    joined = stored.join(opened, keys, "full_outer")
    known, given = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    values = [c for c in tracked if c not in keys]  # keys are equal where both sides are given
    plain = [c for c in plain_columns(active.schema) if c in values and active.schema[c].dataType == batch.schema[c].dataType]
    # a hash that was left out is that of the old values
    differs = F.when(F.col("_old.row_hash").isNull(), texts_differ(values, "_old", "_new", plain)).otherwise(
        F.col("_old.row_hash") != F.unhex(row_hash(list(tracked), "_new", keys, plain))
    )
    expired = known & given & differs
    gone = F.col("_old").withField("status", F.lit("INACTIVE")).withField("eff_end_dt", now).withField("updated_at", now)
    kept = F.when(expired, gone).otherwise(F.col("_old"))
    fresh = F.when(expired | ~known, F.col("_new"))
    # the missing ones of the two are dropped behind the generator: a lambda would be interpreted row by row
    rows = joined.select(*keys, F.explode(F.array(kept, fresh)).alias("_row")).where(F.col("_row").isNotNull())
    return rows.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in columns])


def new_versions(staged: DataFrame, *, batch_id: str, now: Column) -> DataFrame:
    """The versions a staged batch opens."""
    return (
        staged.where(F.col("scd_action") != "UNCHANGED")
        .drop("scd_action")
        .withColumn("status", F.lit("ACTIVE"))
        .withColumn("eff_start_dt", now)
        .withColumn("eff_end_dt", F.lit(OPEN_END).cast("timestamp_ntz"))
        .withColumn("batch_id", F.lit(batch_id))
        .withColumn("created_at", now)
        .withColumn("updated_at", now)
    )


def version_history(table: DataFrame, key: str, value=None) -> DataFrame:
    """Versions with their duration in days; of one key if ``value`` is given."""
    rows = table if value is None else table.where(F.col(key) == value)
    return rows.withColumn("version_duration_days", boundary_diff("day", "eff_start_dt", "eff_end_dt"))
