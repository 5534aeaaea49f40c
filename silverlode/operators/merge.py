"""Upsert and append-if-absent as DataFrame algebra."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AUDIT = ("batch_id", "created_at", "updated_at")


def stamp(df: DataFrame, batch_id: str, now) -> DataFrame:
    """Audit columns of a Silver batch: one value per run."""
    return df.withColumn("batch_id", F.lit(batch_id)).withColumn("created_at", now).withColumn("updated_at", now)


def stored_for(target: DataFrame, batch: DataFrame, keys: Sequence[str], columns: Sequence[str] = ()) -> DataFrame:
    """Keys (and ``columns``) of the target rows a batch speaks about.

    The semi join lets a small batch filter the target where it is read; what is
    left is no larger than the batch, so the joins that follow do not move the target.
    """
    return target.select(*keys, *columns).join(batch.select(*keys), list(keys), "left_semi")


def upsert(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], *, newest_by: str | None = None
) -> DataFrame:
    """The table after the batch: matched rows take the batch values, new rows are added.

    ``created_at`` of a matched row stays.  With ``newest_by`` a batch row older
    than the stored one is ignored (late events).  Both sides hold one row per key.
    The target joins from the left, so that Catalyst broadcasts a small batch and
    does not shuffle the target.
    """
    keys = list(keys)
    columns = target.columns
    values = [c for c in columns if c not in keys and c != "created_at"]
    right = batch.select(*keys, F.struct(*values).alias("_new"))
    wins = F.col("_new").isNotNull()
    if newest_by:
        stored, offered = F.col(newest_by), F.col(f"_new.{newest_by}")
        wins = wins & (stored.isNull() | (offered >= stored))
    updated = target.join(right, keys, "left").select(
        *[
            F.when(wins, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
            for c in columns
        ]
    )
    added = batch.select(*columns).join(stored_for(target, batch, keys), keys, "left_anti")
    return updated.unionByName(added)


def upsert_whole(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], *, newest_by: str | None = None
) -> DataFrame:
    """``upsert`` in one join that moves each side once: for a target that is moved anyway, as it is written again."""
    keys = list(keys)
    rest = [c for c in target.columns if c not in keys]
    old, new = (side.select(*keys, F.struct(*rest).alias(name)) for side, name in ((target, "_old"), (batch, "_new")))
    wins = F.col("_new").isNotNull()
    if newest_by:
        stored, offered = F.col(f"_old.{newest_by}"), F.col(f"_new.{newest_by}")
        wins = wins & (stored.isNull() | (offered >= stored))

    def value(name: str) -> Column:
        stays = F.col("_old").isNotNull() if name == "created_at" else ~F.coalesce(wins, F.lit(False))
        return F.when(stays, F.col(f"_old.{name}")).otherwise(F.col(f"_new.{name}")).alias(name)

    joined = old.join(new, keys, "full_outer")
    return joined.select(*[F.col(c) if c in keys else value(c) for c in target.columns])


def append_absent(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The batch rows whose keys the target does not have yet."""
    return batch.join(stored_for(target, batch, keys), list(keys), "left_anti")


def merge_into_catalog(batch: DataFrame, table: str, keys: Sequence[str]) -> None:
    """The same upsert on a catalog table that supports row-level operations."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & (F.col(f"{table}.{key}") == F.col(f"src.{key}"))
    values = {c: F.col(f"src.{c}") for c in batch.columns if c != "created_at" and c not in keys}
    batch.alias("src").mergeInto(table, condition).whenMatched().update(values).whenNotMatched().insertAll().merge()


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key, by a combining aggregation instead of a window."""
    rest = [c for c in df.columns if c not in keys]
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return newest.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)
