"""The place of every row in one global order, without a task that holds all rows.

Rows are dealt into ranges of the order, sorted within these and written; a range's rows are counted, and the counts of the
ranges before it are added to each row's place within it.  Rows that are equal in all of the order are spread over ranges
like any others and numbered in an order that a written table keeps.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverlode.operators.sequence import sort_columns
from silverlode.session import materialize

_PART, _SEQ, _TIE = "_part", "_seq", "_tie"


def _keys(order: Sequence[str | Column]) -> list[Column]:
    return [c for item in order for c in ([item] if isinstance(item, Column) else sort_columns([item]))]


def with_position(df: DataFrame, order: Sequence[str | Column], alias: str = "position") -> DataFrame:
    """``df`` with the number of each row, from 1, in ``order`` ('a', 'a desc', or a sort expression).

    Positions of rows that the order does not tell apart are in no particular order among them.
    """
    # materialised first: the tie-breaker must be the same when ranges are sampled and when rows are dealt into them
    spread = materialize(df.withColumn(_TIE, F.xxhash64(F.monotonically_increasing_id())), "ties")
    by = [*_keys(order), F.col(_TIE).asc()]
    ranged = spread.repartitionByRange(*by).sortWithinPartitions(*by).drop(_TIE)
    placed = materialize(ranged.withColumn(_PART, F.spark_partition_id()).withColumn(_SEQ, F.monotonically_increasing_id()), "ranges")
    # one row per range: as many as there are partitions
    ranges = placed.groupBy(_PART).agg(F.count(F.lit(1)).alias("_n"), F.min(_SEQ).alias("_first"))
    before = F.sum("_n").over(Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1))
    offsets = ranges.select(_PART, (F.coalesce(before, F.lit(0)) - F.col("_first") + 1).alias("_offset"))
    return placed.join(offsets, _PART).withColumn(alias, F.col(_SEQ) + F.col("_offset")).drop(_PART, _SEQ, "_offset")


def with_dense_rank(df: DataFrame, order: Sequence[str], alias: str = "rank") -> DataFrame:
    """``df`` with its dense rank in ``order`` over all rows: positions of the different values, joined back."""
    names = [item.partition(" ")[0] for item in order]
    values = with_position(df.select(*names).distinct(), order, alias)
    renamed = values.withColumnsRenamed({n: f"_v_{n}" for n in names})
    condition = F.lit(True)
    for name in names:
        condition = condition & F.col(name).eqNullSafe(F.col(f"_v_{name}"))
    return df.join(renamed, condition).drop(*[f"_v_{n}" for n in names])
