"""Join shapes that recur: current versions, wildcard configuration, distinct counts per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def current(df: DataFrame) -> DataFrame:
    """The active version of each key of a versioned table; a table that keeps no versions is returned as it is."""
    return df.where(F.col("status") == "ACTIVE") if "status" in df.columns else df


def as_of(df: DataFrame, moment: Column) -> DataFrame:
    """The version of each key that was valid at ``moment``."""
    return df.where((F.col("eff_start_dt") <= moment) & (moment < F.col("eff_end_dt")))


def lookup(
    df: DataFrame, dimension: DataFrame, keys: Sequence[str] | str, columns: Sequence[str], how: str = "left"
) -> DataFrame:
    """Add ``columns`` of a dimension that has one row per key.

    No broadcast hint: Catalyst and AQE broadcast by size, and split a skewed join otherwise.
    """
    names = [keys] if isinstance(keys, str) else list(keys)
    return df.join(dimension.select(*names, *columns), names, how)


def wildcard_join(df: DataFrame, config: DataFrame, name: str, wildcard: str = "ALL") -> DataFrame:
    """Join configuration rows that name the row's value or the wildcard.

    The OR condition becomes an equi-join: each row offers both of its match values.
    """
    offered = df.withColumn("_match", F.explode(F.array_distinct(F.array(F.col(name), F.lit(wildcard)))))
    return offered.join(config.withColumnRenamed(name, "_match"), "_match").drop("_match")


def group_totals(df: DataFrame, keys: Sequence[str], *measures: Column) -> DataFrame:
    """Join the aggregates of each row's group back to the row (NULL keys form a group).

    Used where a window over the group would put a hot group into one task: the
    aggregation combines before its shuffle, and the join back can be split.
    """
    return with_totals(df, df, keys, *measures)


def with_totals(df: DataFrame, facts: DataFrame, keys: Sequence[str], *measures: Column) -> DataFrame:
    """``group_totals`` whose aggregates are taken from ``facts``, the rows of ``df`` before it was widened."""
    names = [f"_g{i}" for i in range(len(keys))]
    totals = facts.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)]).agg(*measures)
    condition = F.lit(True)
    for key, name in zip(keys, names):
        condition = condition & F.col(key).eqNullSafe(F.col(name))
    return df.join(totals, condition, "left").drop(*names)


def distinct_in_group(df: DataFrame, keys: Sequence[str], column: str, alias: str) -> DataFrame:
    """COUNT(DISTINCT column) over the row's group, which window functions do not offer."""
    return group_totals(df, keys, F.count_distinct(F.col(column)).alias(alias))


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, alias: str) -> DataFrame:
    """The first ``k`` rows of each group; ranks are pre-limited before the shuffle."""
    from pyspark.sql import Window

    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(alias, F.row_number().over(window).cast("long")).where(F.col(alias) <= k)


def split_list(df: DataFrame, column: str, alias: str, separator: str = ",") -> DataFrame:
    """One row per trimmed item of a separated text."""
    return df.withColumn(alias, F.explode(F.split(F.col(column), separator))).withColumn(alias, F.trim(F.col(alias)))
