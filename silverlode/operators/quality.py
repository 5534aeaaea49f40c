"""Rule-driven data quality: first failing rule per row, statistics, and a collect-all mode.

A row that fails one rule is skipped by the later ones, so every bad row has
exactly one error: its first failing rule.  All row-level rules therefore fold
into one projection without a shuffle; only lookups join and duplicates number.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.config import CHECK_TYPES, ConfigError, Rule, ordered_rules
from silverlode.functions.scalar import as_timestamp, boundary_diff
from silverlode.operators.joins import group_totals
from silverlode.operators.sequence import first_of_each

ERROR_KEYS = ["error_id", "validate_column", "validation_type", "ingest_run_id"]
_ERROR, _FIRST = "_dq", "_dq_first"


def _found(position: int) -> str:
    return f"_dq_found_{position}"


def _breaks(rule: Rule, position: int) -> Column:
    """TRUE for rows that break a row-level rule; unknown outcomes are no error."""
    present = F.col(rule.column).isNotNull()
    if rule.kind == "MANDATORY_CHECK":
        return ~F.expr(rule.expression)
    if rule.kind == "VALUE_CHECK":
        return present & ~F.expr(rule.expression)
    if rule.kind == "LOOKUP_CHECK":
        return present & F.col(_found(position)).isNull()
    raise ConfigError(f"unknown validation type {rule.kind!r}")


def validate(
    staged: DataFrame,
    rules: Sequence[Rule],
    key: str,
    references: Mapping[str, DataFrame] | None = None,
    prefer: Sequence[str] = (),
) -> DataFrame:
    """Add ``is_valid`` and the first error (``dq_rule``, ``dq_type``, ``dq_column``, ``dq_message``).

    Duplicates keep exactly one row, the first by key, then ``prefer``, then the
    remaining columns; NULL values are never duplicates.  Until the end a row only
    carries the number of its first broken rule, not the texts of its report.
    """
    columns = [c for c in staged.columns if c != "is_valid"]
    rules = ordered_rules(rules)
    df = staged.select(*columns)
    first = F.lit(None).cast("int")
    for position, rule in reversed(list(enumerate(rules))):
        if rule.kind == "DUPLICATE_ALLOW_ONE_CHECK":
            continue
        if rule.kind == "LOOKUP_CHECK":
            df = _look_up(df, rule, position, references or {})
        first = F.when(_breaks(rule, position), position).otherwise(first)
    df = df.select(*columns, first.alias(_ERROR))
    for position, rule in enumerate(rules):
        if rule.kind == "DUPLICATE_ALLOW_ONE_CHECK":
            df = _number_duplicates(df, rule, position, key, prefer, columns, staged)
    return df.select(*columns, F.col(_ERROR).isNull().alias("is_valid"), *_report(rules))


def _look_up(df: DataFrame, rule: Rule, position: int, references: Mapping[str, DataFrame]) -> DataFrame:
    table, column = rule.lookup
    if table not in references:
        raise ConfigError(f"rule {rule.name} needs reference table {table!r}")
    known = references[table].select(F.col(column).cast("string").alias("_ref")).distinct()
    known = known.withColumn(_found(position), F.lit(True))
    return df.join(known, F.col(rule.column).cast("string") == F.col("_ref"), "left").drop("_ref")


def _report(rules: Sequence[Rule]) -> list[Column]:
    """The texts that belong to the number of the first broken rule."""
    number = F.col(_ERROR)

    def text(values: list[str]) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]).cast("array<string>"), number)

    shown = F.lit("")
    for column in dict.fromkeys(r.column for r in rules):
        mine = [p for p, r in enumerate(rules) if r.column == column and r.kind != "MANDATORY_CHECK"]
        if mine:
            value = F.concat(F.lit(" - Value: "), F.coalesce(F.col(column).cast("string"), F.lit("NULL")))
            shown = F.when(number.isin(*mine), value).otherwise(shown)
    return [
        text([r.name for r in rules]).alias("dq_rule"),
        text([r.kind for r in rules]).alias("dq_type"),
        text([r.column for r in rules]).alias("dq_column"),
        F.concat(text([r.message for r in rules]), shown).alias("dq_message"),
    ]


def _number_duplicates(
    df: DataFrame, rule: Rule, position: int, key: str, prefer: Sequence[str], columns: list[str], staged: DataFrame
) -> DataFrame:
    """All but the first of the rows that are still valid within each value are errors."""
    named = {item.partition(" ")[0] for item in prefer}
    order = list(dict.fromkeys([key, *prefer, *[c for c in columns if c not in named]]))
    still_valid = F.col(_ERROR).isNull() & F.col(rule.column).isNotNull()
    marked = first_of_each(df, [rule.column], order, still_valid, _FIRST, staged)
    extra = still_valid & ~F.col(_FIRST)
    return marked.withColumn(_ERROR, F.when(extra, position).otherwise(F.col(_ERROR))).drop(_FIRST)


def valid_rows(validated: DataFrame) -> DataFrame:
    return validated.where("is_valid").drop("is_valid", "dq_rule", "dq_type", "dq_column", "dq_message")


def error_rows(validated: DataFrame, key: str, run_id: int) -> DataFrame:
    return validated.where("not is_valid").select(
        F.col(key).cast("string").alias("error_id"),
        F.col("dq_column").alias("validate_column"),
        F.col("dq_type").alias("validation_type"),
        F.col("dq_message").alias("validation_error_msg"),
        F.lit(run_id).cast("long").alias("ingest_run_id"),
    )


def new_errors(errors: DataFrame, logged: DataFrame) -> DataFrame:
    """Errors that the table does not hold yet: a repeated run adds nothing.

    Null-safe, since a missing key is itself an error that must be logged once.
    """
    seen = logged.select(*[F.col(c).alias(f"_{c}") for c in ERROR_KEYS]).distinct()
    same = F.lit(True)
    for column in ERROR_KEYS:
        same = same & F.col(column).eqNullSafe(F.col(f"_{column}"))
    return errors.join(seen, same, "left_anti")


def statistics(validated: DataFrame, rules: Sequence[Rule], run_id: int) -> DataFrame:
    """One row: totals, percentages, and checks and errors per validation type as JSON."""
    active = [r for r in rules if r.active]
    total_rows, bad = F.count(F.lit(1)), F.count_if(~F.col("is_valid"))

    def pct(part: Column) -> Column:
        return F.when(total_rows > 0, F.round(part.cast("double") / total_rows * 100, 2)).otherwise(0.0)

    per_type = [
        F.struct(
            F.lit(sum(r.kind == kind for r in active)).alias("checks_executed"),
            F.count_if(F.col("dq_type") == kind).alias("errors_found"),
        ).alias(kind)
        for kind in CHECK_TYPES
    ]
    return validated.agg(
        F.lit(run_id).cast("long").alias("ingest_run_id"),
        total_rows.alias("total_rows_processed"),
        F.count_if(F.col("is_valid")).alias("total_valid_rows"),
        bad.alias("total_invalid_rows"),
        bad.alias("total_error_count"),
        F.lit(len(active)).cast("long").alias("validation_checks_executed"),
        pct(F.count_if(F.col("is_valid"))).alias("valid_rows_percentage"),
        pct(bad).alias("invalid_rows_percentage"),
        pct(bad).alias("error_rate_percentage"),
        F.to_json(F.struct(*per_type)).alias("validation_type_stats"),
    )


def error_summary(errors: DataFrame) -> DataFrame:
    """Errors by message, the most frequent first.

    Messages show values, so most of them occur once: ordered by their count alone, they would all be sorted by one task.
    """
    what = ["validate_column", "validation_type", "validation_error_msg"]
    counted = errors.groupBy(*what).agg(F.count(F.lit(1)).alias("error_count"))
    return counted.orderBy(F.col("error_count").desc(), *what)


def pass_rates(runs: DataFrame) -> DataFrame:
    """Pass rate of each run, latest first."""
    rate = F.col("valid_row_count") / F.nullif(F.col("source_row_count"), F.lit(0)) * 100
    return runs.select(
        "ingest_run_id", "executed_at", "source_row_count", "valid_row_count", "invalid_row_count",
        F.round(rate, 2).alias("pass_rate"),
    ).orderBy(F.col("executed_at").desc())


def report_card(runs: DataFrame, as_of, days: int = 7) -> DataFrame:
    since = as_timestamp(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")
    quality = F.col("valid_row_count") / F.nullif(F.col("source_row_count"), F.lit(0)) * 100
    return runs.where(F.col("executed_at") >= since).groupBy("pipeline_name").agg(
        F.count(F.lit(1)).alias("total_runs"),
        F.count_if(F.col("run_status") == "SUCCESS").alias("success_runs"),
        F.round(F.avg(quality), 2).alias("avg_quality_score"),
    )


def collect_all(df: DataFrame, rules: Sequence[Rule], as_of=None) -> DataFrame:
    """Every row-level error of each row: ``is_valid`` and ``dq_errors`` (an array of structs).

    Kinds: VALUE_RANGE, PATTERN, COMPLETENESS, CONSISTENCY, CUSTOM_QUERY (expressions),
    FRESHNESS (age in days up to the threshold), DUPLICATE (flags all copies),
    STATISTICAL (distance from the mean up to threshold standard deviations).
    """
    columns = df.columns
    errors = []
    for position, rule in enumerate(r for r in rules if r.active and r.kind != "VOLUME"):
        column = F.col(rule.column) if rule.column in columns else None
        if rule.kind == "DUPLICATE":
            counted = f"_copies_{position}"
            df = group_totals(df, [rule.column], F.count(rule.column).alias(counted))
            good = F.col(counted) <= 1
        elif rule.kind == "FRESHNESS" and rule.expression is None:
            good = boundary_diff("day", column, as_timestamp(as_of)) <= rule.threshold
        elif rule.kind == "STATISTICAL" and rule.expression is None:
            centre, spread = f"_mean_{position}", f"_spread_{position}"
            df = df.withColumns({centre: df.agg(F.avg(column)).scalar(), spread: df.agg(F.stddev(column)).scalar()})
            good = F.abs(column - F.col(centre)) <= F.col(spread) * rule.threshold
        else:
            good = F.expr(rule.expression)
        broken = ~good
        if rule.kind in ("PATTERN", "STATISTICAL", "FRESHNESS"):
            broken = column.isNotNull() & broken
        shown = column.cast("string") if column is not None else F.lit(None).cast("string")
        errors.append(
            F.when(
                broken,
                F.struct(
                    F.lit(rule.name).alias("check_name"), F.lit(rule.kind).alias("type"),
                    F.lit(rule.column).alias("column"), F.lit(rule.message).alias("message"),
                    F.lit(rule.severity).alias("severity"), shown.alias("value"),
                ),
            )
        )
    listed = F.filter(F.array(*errors), lambda e: e.isNotNull())
    return df.select(*columns, listed.alias("dq_errors")).withColumn("is_valid", F.size("dq_errors") == 0)


def volume_check(df: DataFrame, rule: Rule) -> DataFrame:
    """Table-level check: one row with the count and whether it reaches the threshold."""
    rows = F.count(F.lit(1))
    good = F.expr(rule.expression) if rule.expression else rows >= rule.threshold
    return df.agg(
        F.lit(rule.name).alias("check_name"),
        rows.alias("row_count"),
        good.alias("is_valid"),
        F.when(~good, F.lit(rule.message)).alias("message"),
    )
