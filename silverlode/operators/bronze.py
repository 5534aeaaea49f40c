"""From text rows to typed Bronze rows: rule projection, raw copies, audit columns."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.config import Column as SourceColumn
from silverlode.config import Source

# When the source says an event happened; NULL for files.
EVENT_TS = "event_ts"
_DECIMAL = re.compile(r"decimal\(\d+,\s*\d+\)")


def typed(column: SourceColumn, strict: bool = False) -> Column:
    """The column's rule.  A failed conversion is NULL, or aborts the load with ``strict``."""
    source = F.col(column.name)

    def convert(value: Column, kind: str) -> Column:
        return value.cast(kind) if strict else value.try_cast(kind)

    trimmed = F.trim(source)
    rule = column.rule
    if rule == "raw":
        value = source
    elif rule == "trim":
        value = trimmed
    elif rule == "upper":
        value = F.upper(trimmed)
    elif rule == "lower":
        value = F.lower(trimmed)
    elif rule == "code":
        value = F.replace(F.upper(trimmed), F.lit(" "), F.lit("_"))
    elif rule == "int":
        value = convert(trimmed, "bigint")
    elif rule == "date":
        value = convert(trimmed, "date")
    elif rule == "timestamp":
        value = convert(trimmed, "timestamp_ntz")
    elif rule == "json":
        value = F.parse_json(source) if strict else F.try_parse_json(source)
        value = F.to_json(value)
    elif _DECIMAL.fullmatch(rule):
        value = convert(trimmed, rule)
    else:
        value = F.expr(rule)
    if column.default is not None:
        value = F.coalesce(value, F.expr(column.default))
    return value.alias(column.name)


def project(df: DataFrame, source: Source, strict: bool = False) -> DataFrame:
    """Typed columns plus, for all columns (stream: all but keys), their raw text."""
    raw = []
    if source.target.raw_columns:
        kept = source.columns if source.ingestion == "BATCH" else [c for c in source.columns if not c.key]
        raw = [F.col(c.name).alias(f"{c.name}_raw") for c in kept]
    event_ts = F.col(EVENT_TS) if EVENT_TS in df.columns else F.lit(None)
    return df.select(
        *[typed(c, strict) for c in source.columns], *raw, event_ts.cast("timestamp_ntz").alias(EVENT_TS)
    )


def audit(df: DataFrame, run_id: int, now: Column) -> DataFrame:
    return df.withColumns({"ingest_run_id": F.lit(run_id).cast("long"), "created_at": now, "updated_at": now})


def surrogate_key(keys: list[str]) -> Column:
    """A stable surrogate: the same business key gives the same number in every run."""
    return F.xxhash64(*keys)


def generated_key(column: str) -> Column:
    """The given key, or a random one for rows that have none."""
    return F.coalesce(F.col(column), F.expr("uuid()"))


def stage(bronze: DataFrame, run_id: int) -> DataFrame:
    """The rows of one run, with a validity flag; prunes to the run's partition."""
    return bronze.where(F.col("ingest_run_id") == run_id).withColumn("is_valid", F.lit(True))
