"""Scalar helpers whose meaning differs between SQL dialects."""

from __future__ import annotations

from collections.abc import Collection
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Values of these types are equal if their texts are, and their texts hold no mark that ``row_text`` escapes.
_PLAIN = (T.IntegralType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def _c(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def div0(numerator: Column | str, denominator: Column | str) -> Column:
    """Ratio in double precision: 0 when the denominator is 0, NULL when it is NULL."""
    top, bottom = _c(numerator).cast("double"), _c(denominator).cast("double")
    return F.when(bottom == 0, F.lit(0.0)).otherwise(top / bottom)


def percent(part: Column | str, whole: Column | str) -> Column:
    return div0(part, whole) * 100


def mean(column: Column | str) -> Column:
    """Average in double precision over an exact sum (same value on every engine)."""
    return F.sum(_c(column)).cast("double") / F.count(_c(column))


def mean_of(total: Column | str, count: Column | str) -> Column:
    """Average from a pre-aggregated sum and count; NULL for an empty group."""
    return F.when(_c(count) > 0, _c(total).cast("double") / _c(count))


def rate(condition: Column) -> Column:
    """Share of rows that satisfy ``condition``, as 0..1."""
    return F.count_if(condition).cast("double") / F.count(F.lit(1))


def _epoch(value: Column) -> Column:
    return F.unix_seconds(value.cast("timestamp"))


def boundary_diff(unit: str, start: Column | str, end: Column | str) -> Column:
    """Number of calendar ``unit`` boundaries crossed between two dates or timestamps."""
    a, b = _c(start), _c(end)
    years = F.year(b) - F.year(a)
    if unit == "year":
        steps = years
    elif unit == "month":
        steps = years * 12 + F.month(b) - F.month(a)
    elif unit == "day":
        steps = F.datediff(F.to_date(b), F.to_date(a))
    elif unit in ("hour", "minute", "second"):
        width = {"hour": 3600, "minute": 60, "second": 1}[unit]
        steps = F.floor(_epoch(b) / width) - F.floor(_epoch(a) / width)
    else:
        raise ValueError(f"unknown unit {unit!r}")
    return steps.cast("long")


def digits_to_int(column: Column | str) -> Column:
    """'45 mins' -> 45; text without digits -> NULL."""
    return F.regexp_replace(_c(column), "[^0-9]", "").try_cast("int")


def plain_columns(schema: T.StructType) -> list[str]:
    """Columns whose texts need no escaping."""
    return [f.name for f in schema if isinstance(f.dataType, _PLAIN)]


def texts_differ(columns: Collection[str], one: str, other: str, plain: Collection[str] = ()) -> Column:
    """Whether ``row_text`` of the columns differs between two structs; ``plain`` ones are compared as they are."""

    def differs(name: str) -> Column:
        a, b = F.col(f"{one}.{name}"), F.col(f"{other}.{name}")
        if name in plain:
            return ~a.eqNullSafe(b)
        return F.coalesce(a.cast("string"), F.lit("")) != F.coalesce(b.cast("string"), F.lit(""))

    found = F.lit(False)
    for name in columns:
        found = found | differs(name)
    return found


def row_text(
    columns: list[str], within: str | None = None, but: Collection[str] = (), plain: Collection[str] = ()
) -> Column:
    """The '|'-joined text of the columns; NULL counts as empty text.

    Separators inside values are escaped, so that moving one cannot hide a change; ``plain`` columns hold none.
    ``within`` names the struct that holds the columns, all ``but`` those given.
    """

    def text(name: str) -> Column:
        given = F.col(name if within is None or name in but else f"{within}.{name}")
        value = F.coalesce(given.cast("string"), F.lit(""))
        for mark in () if name in plain else ("\\", "|"):
            value = F.replace(value, F.lit(mark), F.lit("\\" + mark))
        return value

    return F.concat_ws("|", *[text(name) for name in columns])


def row_hash(
    columns: list[str], within: str | None = None, but: Collection[str] = (), plain: Collection[str] = ()
) -> Column:
    """SHA-256 over ``row_text``."""
    return F.sha2(row_text(columns, within, but, plain), 256)


def as_timestamp(moment: datetime | date | str | Column) -> Column:
    """A point in time as a literal without zone."""
    if isinstance(moment, Column):
        return moment
    return F.lit(str(moment)).cast("timestamp_ntz")


def as_date(moment: datetime | date | str | Column) -> Column:
    return F.to_date(as_timestamp(moment))


def most_common(df: DataFrame, keys: list[str], column: str, alias: str) -> DataFrame:
    """Most frequent non-null value per group; ties go to the smallest value.

    Two combining aggregations, so a hot group is reduced before it is shuffled.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(*keys).agg(F.min_by(column, F.struct(-F.col("_n"), F.col(column))).alias(alias))
