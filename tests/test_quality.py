import json
from dataclasses import replace

import pytest
from support import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from silverlode.catalog import DEFAULT, duplicate, mandatory, value
from silverlode.config import ConfigError, Rule
from silverlode.operators import quality as q

RULES = [
    mandatory("e", "id", text=True),
    value("e", "n", "try_cast(n AS int) > 0", "is not positive"),
    value("e", "s", "s IN ('A', 'B')", "is not valid"),
    duplicate("e", "id"),
]
SCHEMA = "id string, n string, s string"


def checked(spark, data, rules=RULES, **options):
    return q.validate(spark.createDataFrame(data, SCHEMA), rules, "id", **options)


def test_first_failing_rule_wins_and_is_the_only_error(spark):
    result = checked(spark, [("", "-1", "Z"), ("a", "-1", "Z"), ("b", "1", "Z"), ("c", "1", "A")])
    found = {r.id: (r.dq_type, r.dq_column, r.dq_message) for r in result.collect()}
    assert found[""] == ("MANDATORY_CHECK", "id", "ID is mandatory")
    assert found["a"] == ("VALUE_CHECK", "n", "N is not positive - Value: -1")
    assert found["b"] == ("VALUE_CHECK", "s", "S is not valid - Value: Z")
    assert found["c"] == (None, None, None)


def test_null_outcome_is_no_error(spark):
    # 'x' does not convert: NULL > 0 is NULL, and NOT NULL is not TRUE.
    result = checked(spark, [("a", "x", "A"), ("b", None, None)])
    assert all(r.is_valid for r in result.collect())


def test_duplicates_keep_exactly_one_of_the_valid_copies(spark):
    result = checked(spark, [("a", "1", "A"), ("a", "1", "A"), ("a", "2", "A"), ("a", "-5", "A"), (None, "1", "A"), (None, "2", "A")])
    good = result.where("is_valid").collect()
    assert [r.id for r in good] == ["a"]
    kinds = sorted(r.dq_type for r in result.where("not is_valid").collect())
    assert kinds == ["DUPLICATE_ALLOW_ONE_CHECK"] * 2 + ["MANDATORY_CHECK"] * 2 + ["VALUE_CHECK"]


def test_preferred_copy(spark):
    result = checked(spark, [("a", "1", "A"), ("a", "9", "A")], prefer=["n desc"])
    assert [r.n for r in result.where("is_valid").collect()] == ["9"]


def test_lookup(spark):
    known = spark.createDataFrame([("A",), ("A",), (None,)], "s string")
    rule = Rule("lkp", "LOOKUP_CHECK", "s", None, "S unknown", lookup=("ref", "s"))
    result = checked(spark, [("a", "1", "A"), ("b", "1", "Q"), ("c", "1", None)], [rule], references={"ref": known})
    assert {r.id: r.is_valid for r in result.collect()} == {"a": True, "b": False, "c": True}
    with pytest.raises(ConfigError):
        checked(spark, [("a", "1", "A")], [rule])


def test_unknown_type_is_rejected():
    with pytest.raises(ConfigError):
        Rule("r", "GUESS_CHECK", "c")


def test_errors_are_logged_once(spark):
    result = checked(spark, [("", "1", "A"), (None, "1", "A"), ("a", "-1", "A")])
    errors = q.error_rows(result, "id", 5)
    assert errors.count() == 3
    assert q.new_errors(errors, errors).count() == 0
    assert q.new_errors(errors, errors.where("validation_type = 'VALUE_CHECK'")).count() == 2


def test_statistics(spark):
    result = checked(spark, [("", "1", "A"), ("a", "-1", "A"), ("b", "1", "A")])
    stats = q.statistics(result, RULES, 5).first()
    assert (stats.total_rows_processed, stats.total_valid_rows, stats.total_invalid_rows) == (3, 1, 2)
    assert (stats.valid_rows_percentage, stats.invalid_rows_percentage) == (33.33, 66.67)
    assert json.loads(stats.validation_type_stats)["VALUE_CHECK"] == {"checks_executed": 2, "errors_found": 1}
    empty = q.statistics(result.where("false"), RULES, 5).first()
    assert (empty.total_rows_processed, empty.valid_rows_percentage) == (0, 0.0)


def test_collect_all_lists_every_error(spark):
    rules = [
        Rule("range", "VALUE_RANGE", "n", "cast(n AS int) BETWEEN 1 AND 5", "range"),
        Rule("pattern", "PATTERN", "s", "s rlike '^[A-Z]$'", "pattern"),
        Rule("copies", "DUPLICATE", "id", None, "copies"),
    ]
    df = spark.createDataFrame([("a", "9", "AA"), ("a", "1", "A"), ("b", "1", None)], SCHEMA)
    found = sorted((r.id, r.n, [e.check_name for e in r.dq_errors]) for r in q.collect_all(df, rules).collect())
    assert found == [("a", "1", ["copies"]), ("a", "9", ["range", "pattern", "copies"]), ("b", "1", [])]


def test_volume(spark):
    rule = Rule("enough", "VOLUME", "TABLE_LEVEL", None, "too few", threshold=3)
    df = spark.createDataFrame([("a", "1", "A")] * 2, SCHEMA)
    row = q.volume_check(df, rule).first()
    assert (row.row_count, row.is_valid, row.message) == (2, False, "too few")


def test_builtin_rules():
    assert [len(DEFAULT.rules[e]) for e in ("order", "delivery", "order_item")] == [14, 13, 15]
    assert sum(r.active for e in DEFAULT.rules.values() for r in e) == 35
    order = [r.kind for r in DEFAULT.rules_for("order_item")]
    assert order == sorted(order, key=["MANDATORY_CHECK", "VALUE_CHECK", "LOOKUP_CHECK", "DUPLICATE_ALLOW_ONE_CHECK"].index)


def test_status_values_are_normalised(spark):
    rule = next(r for r in DEFAULT.rules["delivery"] if r.name == "delivery_value_delivery_status")
    df = spark.createDataFrame([("a", "Picked Up", ""), ("b", " in transit ", ""), ("c", "NEARBY", ""), ("d", "Lost", "")], SCHEMA)
    result = q.validate(df.withColumnRenamed("n", "delivery_status"), [replace(rule, active=True)], "id")
    assert {r.id: r.is_valid for r in result.collect()} == {"a": True, "b": True, "c": True, "d": False}


texts = st.sampled_from(["", "a", "b", "1", "-1", None])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(texts, texts, texts), min_size=1, max_size=12))
def test_rows_are_split_without_loss(spark, data):
    result = checked(spark, data)
    good, bad = q.valid_rows(result), q.error_rows(result, "id", 1)
    assert good.count() + bad.count() == len(data)
    assert good.count() == good.select("id").distinct().count()
    assert rows(result.select("id", "n", "s")) == sorted((tuple(d) for d in data), key=repr)
