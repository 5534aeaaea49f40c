"""Data-quality queries over the raw line items, with their checks."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from silverlode.catalog import DEFAULT
from silverlode.config import Rule
from silverlode.operators import quality as q
from workbook.core import EVENT_AS_OF, case

KEY, RUN = "order_item_id", 7
# With the lookup rules switched on.
RULES = [replace(r, active=True) for r in DEFAULT.rules["order_item"]]


def _number(column: str) -> str:
    return f"try_cast({column} AS decimal(10,2))"


# Rule name, type, column, condition of a good row, message.
CHECKS = [
    *[
        (f"order_item_mandatory_{c}", "MANDATORY_CHECK", c, f"{c} IS NOT NULL" + (f" AND trim({c}) <> ''" if text else ""), f"{c.upper()} is mandatory")
        for c, text in (("order_item_id", True), ("order_id", True), ("menu_id", False), ("quantity", False), ("price", False), ("subtotal", False))
    ],
    ("order_item_value_menu_id", "VALUE_CHECK", "menu_id", "try_cast(menu_id AS bigint) IS NOT NULL", "MENU_ID is not a valid integer"),
    ("order_item_value_quantity", "VALUE_CHECK", "quantity", f"{_number('quantity')} IS NOT NULL AND {_number('quantity')} > 0", "QUANTITY is not a valid positive number"),
    ("order_item_value_price", "VALUE_CHECK", "price", f"{_number('price')} IS NOT NULL AND {_number('price')} >= 0", "PRICE is not a valid non-negative number"),
    ("order_item_value_subtotal", "VALUE_CHECK", "subtotal", f"{_number('subtotal')} IS NOT NULL AND {_number('subtotal')} >= 0", "SUBTOTAL is not a valid non-negative number"),
    ("order_item_value_order_timestamp", "VALUE_CHECK", "order_timestamp", "try_cast(order_timestamp AS date) IS NOT NULL", "ORDER_TIMESTAMP is not a valid date"),
    ("order_item_value_subtotal_calc", "VALUE_CHECK", "subtotal", f"abs({_number('subtotal')} - {_number('quantity')} * {_number('price')}) < 0.01", "SUBTOTAL does not match QUANTITY * PRICE"),
    ("order_item_lookup_order_id", "LOOKUP_CHECK", "order_id", "order_id IN (SELECT cast(o_orderkey AS varchar) FROM orders)", "ORDER_ID does not exist in reference table"),
    ("order_item_lookup_menu_id", "LOOKUP_CHECK", "menu_id", "menu_id IN (SELECT cast(menu_id AS varchar) FROM dim_menu WHERE availability = 'AVAILABLE')", "MENU_ID does not exist in reference table"),
]
COLUMNS = "order_item_id, order_id, menu_id, quantity, price, subtotal, order_timestamp, src_partkey, src_suppkey"


def _case(position: int, message: bool = False) -> str:
    arms = []
    for name, kind, column, good, text in CHECKS:
        present = "" if kind == "MANDATORY_CHECK" else f"{column} IS NOT NULL AND "
        shown = f"'{text}'" if kind == "MANDATORY_CHECK" else f"concat('{text} - Value: ', coalesce({column}, 'NULL'))"
        value = shown if message else f"'{(name, kind, column)[position]}'"
        arms.append(f"WHEN {present}NOT ({good}) THEN {value}")
    return "CASE " + " ".join(arms) + " END"


VALIDATED_SQL = f"""
WITH e AS (SELECT {COLUMNS}, {_case(0)} AS r, {_case(1)} AS k, {_case(2)} AS c, {_case(0, True)} AS m FROM order_item_raw),
n AS (SELECT *, row_number() OVER (PARTITION BY order_item_id, r IS NULL ORDER BY {COLUMNS}) AS rn FROM e),
validated AS (
  SELECT {COLUMNS}, r IS NULL AND rn = 1 AS is_valid, coalesce(r, CASE WHEN rn > 1 THEN 'order_item_duplicate_order_item_id' END) AS dq_rule,
    coalesce(k, CASE WHEN rn > 1 THEN 'DUPLICATE_ALLOW_ONE_CHECK' END) AS dq_type, coalesce(c, CASE WHEN rn > 1 THEN 'order_item_id' END) AS dq_column,
    coalesce(m, CASE WHEN rn > 1 THEN concat('Duplicate ORDER_ITEM_ID found - Value: ', order_item_id) END) AS dq_message FROM n)"""


def validated(t):
    references = {
        "order_brz": t["orders"].select(F.col("o_orderkey").alias("order_id")),
        "dim_menu": t["dim_menu"].where(F.col("availability") == "AVAILABLE"),
    }
    return q.validate(t["order_item_raw"], RULES, KEY, references)


ERRORS = f"SELECT order_item_id AS error_id, dq_column AS validate_column, dq_type AS validation_type, dq_message AS validation_error_msg, cast({RUN} AS bigint) AS ingest_run_id FROM validated WHERE NOT is_valid"


def errors(t):
    return q.error_rows(validated(t), KEY, RUN)


@case("q7_validate", f"{VALIDATED_SQL} SELECT * FROM validated")
def _(t):
    return validated(t)


def _errors_of(name, kind):
    @case(name, f"{VALIDATED_SQL} {ERRORS} AND dq_type = '{kind}'")
    def _(t):
        return errors(t).where(F.col("validation_type") == kind)


_errors_of("q2_mandatory", "MANDATORY_CHECK")
_errors_of("q3_value", "VALUE_CHECK")
_errors_of("q4_lookup", "LOOKUP_CHECK")
_errors_of("q5_duplicate", "DUPLICATE_ALLOW_ONE_CHECK")


@case("q6_business_rule", f"{VALIDATED_SQL} SELECT order_item_id, quantity, price, subtotal, dq_message FROM validated WHERE dq_rule = 'order_item_value_subtotal_calc'")
def _(t):
    broken = validated(t).where(F.col("dq_rule") == "order_item_value_subtotal_calc")
    return broken.select("order_item_id", "quantity", "price", "subtotal", "dq_message")


@case("q8_new_errors", f"{VALIDATED_SQL} SELECT * FROM ({ERRORS}) x WHERE validation_type <> 'VALUE_CHECK'")
def _(t):
    found = errors(t)
    return q.new_errors(found, found.where(F.col("validation_type") == "VALUE_CHECK"))


@case(
    "q10_statistics",
    f"""{VALIDATED_SQL} SELECT cast({RUN} AS bigint) AS ingest_run_id, count(*) AS total_rows_processed, count(*) FILTER (is_valid) AS total_valid_rows,
      count(*) FILTER (NOT is_valid) AS total_invalid_rows, count(*) FILTER (NOT is_valid) AS total_error_count, cast(15 AS bigint) AS validation_checks_executed,
      round(cast(count(*) FILTER (is_valid) AS double) / count(*) * 100, 2) AS valid_rows_percentage,
      round(cast(count(*) FILTER (NOT is_valid) AS double) / count(*) * 100, 2) AS invalid_rows_percentage,
      round(cast(count(*) FILTER (NOT is_valid) AS double) / count(*) * 100, 2) AS error_rate_percentage,
      concat('{{"MANDATORY_CHECK":{{"checks_executed":6,"errors_found":', count(*) FILTER (dq_type = 'MANDATORY_CHECK'), '}},"VALUE_CHECK":{{"checks_executed":6,"errors_found":',
        count(*) FILTER (dq_type = 'VALUE_CHECK'), '}},"LOOKUP_CHECK":{{"checks_executed":2,"errors_found":', count(*) FILTER (dq_type = 'LOOKUP_CHECK'),
        '}},"DUPLICATE_ALLOW_ONE_CHECK":{{"checks_executed":1,"errors_found":', count(*) FILTER (dq_type = 'DUPLICATE_ALLOW_ONE_CHECK'), '}}}}') AS validation_type_stats FROM validated""",
)
def _(t):
    return q.statistics(validated(t), RULES, RUN)


@case("q11_valid_rows", f"{VALIDATED_SQL} SELECT {COLUMNS} FROM validated WHERE is_valid")
def _(t):
    return q.valid_rows(validated(t))


@case("q13_error_summary", f"{VALIDATED_SQL} SELECT dq_column AS validate_column, dq_type AS validation_type, dq_message AS validation_error_msg, count(*) AS error_count FROM validated WHERE NOT is_valid GROUP BY ALL")
def _(t):
    return q.error_summary(errors(t))


@case(
    "q14_pass_rates",
    """SELECT ingest_run_id, executed_at, source_row_count, valid_row_count, invalid_row_count, round(cast(valid_row_count AS double) / nullif(source_row_count, 0) * 100, 2) AS pass_rate FROM ingest_run""",
)
def _(t):
    return q.pass_rates(t["ingest_run"])


@case(
    "q14_report_card",
    f"""SELECT pipeline_name, count(*) AS total_runs, count(*) FILTER (run_status = 'SUCCESS') AS success_runs,
      round(avg(cast(valid_row_count AS double) / nullif(source_row_count, 0) * 100), 2) AS avg_quality_score
      FROM ingest_run WHERE executed_at >= TIMESTAMP '{EVENT_AS_OF}' - INTERVAL '7' DAY GROUP BY 1""",
)
def _(t):
    return q.report_card(t["ingest_run"], EVENT_AS_OF)


def _extended(name: str, rule: Rule, broken: str):
    """A single extended check: the keys of the rows it flags, and the value shown."""
    shown = rule.column if rule.column in COLUMNS.split(", ") else "cast(NULL AS varchar)"

    @case(name, f"SELECT order_item_id, src_partkey, src_suppkey, '{rule.name}' AS check_name, cast({shown} AS varchar) AS value FROM ({broken}) x")
    def _(t):
        flagged = q.collect_all(t["order_item_raw"], [rule], "2001-08-01").where("not is_valid")
        first = F.col("dq_errors")[0]
        return flagged.select("order_item_id", "src_partkey", "src_suppkey", first.check_name.alias("check_name"), first.value.alias("value"))


ALL = "SELECT * FROM order_item_raw"
_extended("q12_value_range", Rule("range_quantity", "VALUE_RANGE", "quantity", "try_cast(quantity AS int) BETWEEN 1 AND 40", "out of range"), f"{ALL} WHERE NOT (try_cast(quantity AS integer) BETWEEN 1 AND 40)")
_extended("q12_pattern", Rule("pattern_timestamp", "PATTERN", "order_timestamp", r"order_timestamp rlike '^[0-9]{4}-[0-9]{2}-[0-9]{2}$'", "wrong shape"), f"{ALL} WHERE NOT regexp_matches(order_timestamp, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$')")
_extended("q12_duplicate", Rule("duplicate_item", "DUPLICATE", "order_item_id", None, "duplicate"), f"{ALL} QUALIFY count(*) OVER (PARTITION BY order_item_id) > 1")
_extended("q12_completeness", Rule("complete_keys", "COMPLETENESS", "Multiple", "order_id <> '' AND menu_id <> 'NULL'", "incomplete"), f"{ALL} WHERE NOT (order_id <> '' AND menu_id <> 'NULL')")
_extended("q12_consistency", Rule("consistent_subtotal", "CONSISTENCY", "subtotal", "cast(subtotal AS decimal(18,2)) = cast(price AS decimal(18,2)) * cast(quantity AS int)", "inconsistent"), f"{ALL} WHERE NOT (cast(subtotal AS decimal(18,2)) = cast(price AS decimal(18,2)) * cast(quantity AS integer))")
_extended("q12_freshness", Rule("fresh_order", "FRESHNESS", "order_timestamp", "datediff(DATE'2001-08-01', try_cast(order_timestamp AS date)) <= 1500", "stale"), f"{ALL} WHERE NOT (date_diff('day', try_cast(order_timestamp AS date), DATE '2001-08-01') <= 1500)")
_extended("q12_custom_query", Rule("dear_and_many", "CUSTOM_QUERY", "Multiple", "NOT (cast(price AS decimal(18,2)) > 90000 AND cast(quantity AS int) > 45)", "unusual"), f"{ALL} WHERE cast(price AS decimal(18,2)) > 90000 AND cast(quantity AS integer) > 45")


@case(
    "q12_statistical",
    """SELECT order_id, total_amount FROM (SELECT order_id, cast(total_amount AS double) AS total_amount, avg(cast(total_amount AS double)) OVER () AS m, stddev(cast(total_amount AS double)) OVER () AS s FROM fact_order) x
       WHERE NOT (abs(total_amount - m) <= 1.5 * s)""",
)
def _(t):
    rule = Rule("outlier_amount", "STATISTICAL", "total_amount", None, "outlier", threshold=1.5)
    orders = t["fact_order"].select("order_id", F.col("total_amount").cast("double").alias("total_amount"))
    return q.collect_all(orders, [rule]).where("not is_valid").select("order_id", "total_amount")


@case("q12_volume", "SELECT 'enough_items' AS check_name, count(*) AS row_count, count(*) >= 1000000 AS is_valid, CASE WHEN NOT count(*) >= 1000000 THEN 'too few rows' END AS message FROM order_item_raw")
def _(t):
    return q.volume_check(t["order_item_raw"], Rule("enough_items", "VOLUME", "TABLE_LEVEL", None, "too few rows", threshold=1_000_000))


@case(
    "q12_collect_all",
    f"""SELECT order_item_id, src_partkey, src_suppkey, concat_ws(',', CASE WHEN order_id = '' THEN 'complete_order' END, CASE WHEN quantity = '0' THEN 'range_quantity' END,
        CASE WHEN order_timestamp = 'unknown' THEN 'pattern_timestamp' END) AS failed FROM ({ALL}) x WHERE order_id = '' OR quantity = '0' OR order_timestamp = 'unknown'""",
)
def _(t):
    rules = [
        Rule("complete_order", "COMPLETENESS", "order_id", "order_id <> ''", "incomplete"),
        Rule("range_quantity", "VALUE_RANGE", "quantity", "cast(quantity AS int) > 0", "out of range"),
        Rule("pattern_timestamp", "PATTERN", "order_timestamp", "order_timestamp rlike '^[0-9-]+$'", "wrong shape"),
    ]
    flagged = q.collect_all(t["order_item_raw"], rules).where("not is_valid")
    failed = F.array_join(F.transform("dq_errors", lambda e: e.check_name), ",").alias("failed")
    return flagged.select("order_item_id", "src_partkey", "src_suppkey", failed)


