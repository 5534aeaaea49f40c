"""Query registry: a DataFrame function, its check SQL, and one output type per kind of value."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.session import tune
from silverlode.sources.driver_tables import Entities
from workbook.views import with_views

MODULES = (
    "customer", "delivery", "orders", "restaurant", "reports", "quality", "versions", "columns", "shapes",
    "operations", "monitors", "sources", "streams", "comparisons", "endtoend",
)

# Reporting dates of the driver data: the order tables end in 2001, the event table in 2024.
ORDER_AS_OF = "2001-08-01 00:00:00"
EVENT_AS_OF = "2024-01-31 00:00:00"


@dataclass(frozen=True)
class Case:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


CASES: dict[str, Case] = {}


def tidy(df: DataFrame) -> DataFrame:
    """Whole numbers as bigint, decimals as double, timestamps without zone."""

    def column(field: T.StructField):
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            value = value.cast("long")
        elif isinstance(field.dataType, (T.DecimalType, T.FloatType)):
            value = value.cast("double")
        elif isinstance(field.dataType, T.TimestampType):
            value = value.cast("timestamp_ntz")
        return value.alias(field.name)

    return df.select(*[column(f) for f in df.schema])


def case(name: str, sql: str | None = None):
    """Register ``fn(entities) -> DataFrame`` under ``name``."""

    def register(fn: Callable[[Entities], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return tidy(fn(Entities(tune(spark), folder)))

        if name in CASES:
            raise ValueError(f"{name} is registered twice")
        CASES[name] = Case(name, run, with_views(sql) if sql else None)
        return fn

    return register


def load_all() -> dict[str, Case]:
    for module in MODULES:
        importlib.import_module(f"workbook.{module}")
    return CASES
