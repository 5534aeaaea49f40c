"""Ordered features per key (numbering, lag/lead, moving and running values, totals).

A window function puts every row of its partition into one task.  That is wrong for a key that may hold a third of the
table, so a key is cut into segments by its first order column: each hour of a timestamp, each day of a date.  Windows run
within a segment.  What a segment needs from the others (how many rows and which sums come before it, the rows next to
it, the totals of its key) is worked out from one row per key and segment, and travels as one extra row that sorts
before the segment's own, so rows are shuffled once and never joined.  A key has at most as many summary rows as the
calendar has hours.  The plan is the same at every size; building it runs no job and writes nothing.

Where the caller knows that a key is small (after an aggregation to days, or within a dimension) it says ``bounded``,
which is a plain window.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SEG, _REAL, _CARRY = "_seg", "_real", "_carry"
#: Groups over which the rows of one value are dealt out by ``first_of_each``.
_SHARES = 256
#: Rows of one value that a plain window may hold.
HOT_ROWS = 1 << 16


@dataclass(frozen=True)
class Feature:
    alias: str
    kind: str
    column: str | None = None
    rows: int = 0
    fn: str = "sum"


def row_number(alias: str) -> Feature:
    return Feature(alias, "row_number")


def lag(alias: str, column: str, rows: int = 1) -> Feature:
    return Feature(alias, "lag", column, rows)


def lead(alias: str, column: str, rows: int = 1) -> Feature:
    return Feature(alias, "lead", column, rows)


def moving_average(alias: str, column: str, rows: int) -> Feature:
    """Average over the current row and the ``rows - 1`` rows before it."""
    return Feature(alias, "moving", column, rows, "avg")


def running(alias: str, fn: str, column: str) -> Feature:
    """``sum``, ``count`` or ``avg`` from the first row of the key up to the current row."""
    return Feature(alias, "running", column, fn=fn)


def total(alias: str, fn: str, column: str) -> Feature:
    """``sum``, ``count`` or ``avg`` over all rows of the key."""
    return Feature(alias, "total", column, fn=fn)


def sort_columns(order: Sequence[str]) -> list[Column]:
    """'a' sorts ascending with NULL first, 'a desc' descending with NULL last."""
    out = []
    for item in order:
        name, _, direction = item.partition(" ")
        out.append(F.col(name).desc() if direction == "desc" else F.col(name).asc())
    return out


def _order_names(order: Sequence[str]) -> list[str]:
    return [item.partition(" ")[0] for item in order]


def _measure(fn: str, column: Column, window) -> Column:
    if fn == "count":
        return F.count(column).over(window)
    if fn == "sum":
        return F.sum(column).over(window)
    if fn == "avg":
        return F.sum(column).over(window).cast("double") / F.count(column).over(window)
    raise ValueError(f"unknown function {fn!r}")


def _bounded(feature: Feature, ordered) -> Column:
    column = F.col(feature.column)
    if feature.kind == "lag":
        return F.lag(column, feature.rows).over(ordered)
    if feature.kind == "lead":
        return F.lead(column, feature.rows).over(ordered)
    return _measure("avg", column, ordered.rowsBetween(1 - feature.rows, 0))


def _plain(df: DataFrame, keys: Sequence[str], order: Sequence[str], features: Sequence[Feature]) -> DataFrame:
    whole = Window.partitionBy(*keys)
    ordered = whole.orderBy(*sort_columns(order))
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def expression(feature: Feature) -> Column:
        if feature.kind == "row_number":
            return F.row_number().over(ordered).cast("long")
        if feature.kind == "running":
            return _measure(feature.fn, F.col(feature.column), so_far)
        if feature.kind == "total":
            return _measure(feature.fn, F.col(feature.column), whole)
        return _bounded(feature, ordered)

    return df.select("*", *[expression(f).alias(f.alias) for f in features])


def with_features(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], features: Sequence[Feature], bounded: bool = False,
    facts: DataFrame | None = None,
) -> DataFrame:
    """Add ordered per-key features.  ``order`` should end in a unique tie-breaker.

    Unless ``bounded``, the first order column is a date or timestamp, all of them ascend, and lag and lead reach one row.
    ``facts`` are the rows of ``df`` before they were widened: segments are summed up from these, so that what
    widened ``df`` is worked out once.
    """
    if bounded:
        return _plain(df, list(keys), order, features)
    return _segmented(df, list(keys), order, features, df if facts is None else facts)


def _segment(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    if isinstance(kind, T.DateType):
        return F.col(column)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_trunc("hour", column)
    raise ValueError(f"{column!r} is no date or timestamp to cut keys by; use an aggregation, or bounded keys")


def _segmented(df: DataFrame, keys: list[str], order: Sequence[str], features: Sequence[Feature], facts: DataFrame) -> DataFrame:
    near = [f for f in features if f.kind in ("lag", "lead")]
    if any(" " in item for item in order) or any(f.kind == "moving" for f in features) or any(f.rows != 1 for f in near):
        raise ValueError("descending orders, moving averages and distant rows are for bounded keys")
    kinds = {field.name: field.dataType for field in _plain(df, keys, order, features).schema}
    sums = [f for f in features if f.kind in ("running", "total")]
    behind = list(dict.fromkeys(f.column for f in features if f.kind == "lag"))
    ahead = list(dict.fromkeys(f.column for f in features if f.kind == "lead"))
    rows = df.withColumn(_SEG, _segment(df, order[0]))

    # one row per key and segment; combined before its shuffle
    place = F.struct(*order)
    measures = [F.count(F.lit(1)).alias("_n")]
    for f in sums:
        measures.append(F.count(f.column).alias(f"_c_{f.alias}"))
        if f.fn != "count":
            measures.append(F.sum(f.column).alias(f"_s_{f.alias}"))
    if behind:
        measures.append(F.max_by(F.struct(*behind), place).alias("_last"))
    if ahead:
        measures.append(F.min_by(F.struct(*ahead), place).alias("_first"))
    summary = facts.withColumn(_SEG, _segment(facts, order[0])).groupBy(*keys, _SEG).agg(*measures)

    along = Window.partitionBy(*keys).orderBy(_SEG)
    before, whole = along.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(*keys)
    carried = [F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("n")]
    for f in sums:
        span = before if f.kind == "running" else whole
        carried.append(F.coalesce(F.sum(f"_c_{f.alias}").over(span), F.lit(0)).alias(f"c_{f.alias}"))
        if f.fn != "count":
            carried.append(F.sum(f"_s_{f.alias}").over(span).alias(f"s_{f.alias}"))
    if ahead:
        carried.append(F.lead("_first").over(along).alias("next"))
    last = F.lag("_last").over(along) if behind else None
    picked = [*keys, _SEG, *[c.alias(f"_x{i}") for i, c in enumerate(carried)]]
    extra = summary.select(*picked, *([last.alias("_previous")] if behind else []))
    names = ["n", *[x for f in sums for x in ([f"c_{f.alias}"] + ([f"s_{f.alias}"] if f.fn != "count" else []))], *(["next"] if ahead else [])]
    carry = F.struct(*[F.col(f"_x{i}").alias(name) for i, name in enumerate(names)])
    # the extra row holds the values of the row before its segment, so that lag finds them
    taken = {c: F.col(f"_previous.{c}") for c in behind}
    extra = extra.select(*keys, _SEG, carry.alias(_CARRY), F.lit(False).alias(_REAL), *[v.alias(f"_l_{c}") for c, v in taken.items()])
    body = rows.withColumn(_REAL, F.lit(True)).withColumns({f"_l_{c}": F.col(c) for c in behind}).unionByName(extra, allowMissingColumns=True)

    ordered = Window.partitionBy(*keys, _SEG).orderBy(_REAL, *sort_columns(order))
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sent = F.first(_CARRY).over(so_far)

    def local(f: Feature) -> Column:
        if f.kind == "row_number":
            return sent["n"] + F.row_number().over(ordered) - 1
        if f.kind == "lag":
            return F.lag(f"_l_{f.column}").over(ordered)
        if f.kind == "lead":
            return F.when(F.lead(_REAL).over(ordered).isNotNull(), F.lead(f.column).over(ordered)).otherwise(sent["next"][f.column])
        count, value = sent[f"c_{f.alias}"], None if f.fn == "count" else sent[f"s_{f.alias}"]
        if f.kind == "running":
            own = F.when(F.col(_REAL), F.col(f.column))
            count = count + F.count(own).over(so_far)
            if value is not None:
                here = F.sum(own).over(so_far)
                value = F.coalesce(value + here, value, here)
        if value is None:
            return count
        return value if f.fn == "sum" else value.cast("double") / count

    made = [local(f).cast(kinds[f.alias]).alias(f.alias) for f in features]
    return body.select(*df.columns, _REAL, *made).where(_REAL).drop(_REAL)


def first_of_each(df: DataFrame, keys: Sequence[str], order: Sequence[str], among: Column, alias: str, facts: DataFrame | None = None) -> DataFrame:
    """``alias``: whether a row is the first of its key (NULL keys form one) of the rows where ``among`` holds.

    Rows move once, to a window of their key.  Only those of hot keys, of over HOT_ROWS rows, move twice: they are dealt out
    over shares by the partition they come from, the first of each share is found, and then the first of those, so no
    task holds all rows of a hot key, copies of one row included.  Hot keys are counted from the keys of ``facts`` (the rows of
    ``df`` before they were widened); there are at most (rows / HOT_ROWS) of them.
    """
    columns, by, real = df.columns, sort_columns(order), F.coalesce(among, F.lit(False))
    names = [f"_hot_{i}" for i in range(len(keys))]
    counted = (df if facts is None else facts).groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)]).agg(F.count(F.lit(1)).alias("_rows"))
    hot, same = F.broadcast(counted.where(F.col("_rows") > HOT_ROWS).drop("_rows")), F.lit(True)
    for key, name in zip(keys, names):
        same = same & F.col(key).eqNullSafe(F.col(name))

    few = df.join(hot, same, "left_anti").withColumn("_among", real)
    place = F.row_number().over(Window.partitionBy(*keys, "_among").orderBy(*by))
    few = few.select(*columns, (F.col("_among") & (place == 1)).alias(alias))

    shared = df.join(hot, same, "left_semi").withColumn("_among", real).withColumn("_share", F.pmod(F.spark_partition_id(), F.lit(_SHARES)))
    local = shared.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys, "_among", "_share").orderBy(*by)))
    finalist = F.col("_among") & (F.col("_rank") == 1)
    grouped = local.withColumn("_share", F.when(finalist, -1).otherwise(F.col("_share")))
    final = F.row_number().over(Window.partitionBy(*keys, "_among", "_share").orderBy(*by))
    return few.unionByName(grouped.select(*columns, ((F.col("_share") == -1) & (final == 1)).alias(alias)))
