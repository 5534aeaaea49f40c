from datetime import datetime, timedelta

import pytest

from silverlode.config import ConfigError, Retry, Sla
from silverlode.plans import operations as ops

NOW = datetime(2024, 1, 31)


def ago(**span):
    return NOW - timedelta(**span)


def test_retry_limits_delay_backoff_and_order(spark):
    letters = spark.createDataFrame(
        [
            (1, "P", "TECHNICAL", "PENDING", 0, None, ago(hours=5)),
            (2, "P", "TECHNICAL", "PENDING", 1, ago(seconds=599), ago(hours=6)),
            (3, "P", "TECHNICAL", "PENDING", 1, ago(seconds=601), ago(hours=7)),
            (4, "P", "TECHNICAL", "PENDING", 3, ago(days=1), ago(hours=8)),
            (5, "P", "VALIDATION", "PENDING", 0, None, ago(hours=9)),
            (6, "P", "TECHNICAL", "RESOLVED", 0, None, ago(hours=9)),
            (7, "Q", "TECHNICAL", "PENDING", 0, None, ago(hours=9)),
        ],
        "dlq_id int, pipeline_name string, error_type string, processing_status string, retry_count int, last_retry_at timestamp_ntz, created_at timestamp_ntz",
    )
    retries = [Retry("P", "TECHNICAL", 3, 300), Retry("ALL", "VALIDATION", 0, 0)]
    assert [r.dlq_id for r in ops.retry_candidates(letters, retries, NOW).collect()] == [3, 1]
    assert [r.dlq_id for r in ops.retry_candidates(letters, retries, NOW, backoff=False).collect()] == [3, 2, 1]
    assert [r.dlq_id for r in ops.retry_candidates(letters, retries, NOW, limit=1).collect()] == [3]


def test_settled_states(spark):
    letters = spark.createDataFrame(
        [(1, "PENDING", 0, None), (2, "PENDING", 2, None), (3, "PENDING", 0, None), (4, "RESOLVED", 1, None)],
        "dlq_id int, processing_status string, retry_count int, last_retry_at timestamp_ntz",
    )
    tried = spark.createDataFrame([(1, 3), (2, 3), (3, 3)], "dlq_id int, max_retries int")
    outcome = spark.createDataFrame([(1, True), (2, False), (3, False)], "dlq_id int, succeeded boolean")
    after = {r.dlq_id: (r.processing_status, r.retry_count, r.last_retry_at) for r in ops.settle_retries(letters, tried, outcome, NOW).collect()}
    assert after == {1: ("RESOLVED", 1, NOW), 2: ("ABANDONED", 3, NOW), 3: ("PENDING", 1, NOW), 4: ("RESOLVED", 1, None)}


@pytest.mark.parametrize("counts, status", [((1000, 1000, 1000), "PASS"), ((1000, 995, 990), "WARNING"), ((1000, 990, 989), "FAIL"), ((0, 0, 0), "PASS")])
def test_reconciliation_thresholds(spark, counts, status):
    df = spark.createDataFrame([("p", "b", *counts)], "pipeline_name string, batch_id string, bronze long, silver long, gold long")
    found = ops.reconcile_counts(df).collect()
    assert [r.layer for r in found] == ["BRONZE->SILVER", "SILVER->GOLD"]
    assert {r.reconciliation_status for r in found} == {status}
    assert found[0].missing_in_target == counts[0] - counts[1]


RUNS = "ingest_run_id int, pipeline_name string, run_status string, source_row_count long, valid_row_count long, execution_duration_sec double, executed_at timestamp_ntz"


def runs(spark, data):
    return spark.createDataFrame([(i, *row) for i, row in enumerate(data)], RUNS)


def test_sla_operators_wildcard_and_empty_runs(spark):
    df = runs(spark, [("A", "SUCCESS", 0, 0, 10.0, ago(hours=1)), ("A", "FAILED", 100, 50, 30.0, ago(hours=2)), ("B", "SUCCESS", 10, 10, 5.0, ago(hours=30))])
    slas = [
        Sla("A", "LATENCY", "20", ">=", "SECONDS"), Sla("A", "LATENCY", "20", ">", "SECONDS"), Sla("ALL", "QUALITY", "75", "=", "PERCENTAGE"),
        Sla("ALL", "AVAILABILITY", "99", "<", "PERCENTAGE", "CRITICAL"), Sla("B", "LATENCY", "1", ">", "SECONDS"), Sla("A", "QUALITY", "1", ">", "PERCENTAGE", active=False),
    ]
    found = [(r.pipeline_name, r.metric_type, r.sla_threshold, r.sla_status) for r in ops.sla_dashboard(df, slas, NOW).collect()]
    assert sorted(found) == sorted(
        [
            ("A", "LATENCY", ">= 20.00 SECONDS", ops.BREACH), ("A", "LATENCY", "> 20.00 SECONDS", ops.OK),
            ("A", "QUALITY", "= 75.00 PERCENTAGE", ops.BREACH), ("A", "AVAILABILITY", "< 99.00 PERCENTAGE", ops.BREACH),
        ]
    )
    with pytest.raises(ConfigError):
        Sla("A", "LATENCY", "1", "~", "SECONDS")


def test_degradation_needs_three_recent_runs(spark):
    base = [("A", "SUCCESS", 100, 100, 10.0 + i % 2, ago(days=2 + i % 4)) for i in range(8)]
    slow = [("A", "SUCCESS", 100, 100, 40.0, ago(hours=i + 1)) for i in range(3)]
    found = ops.performance_degradation(runs(spark, base + slow), NOW).first()
    assert (found.performance_status, found.alert_message) == (ops.DEGRADED, "Execution time increased by 281%")
    assert ops.performance_degradation(runs(spark, base + slow[:2]), NOW).count() == 0
    worse = [("A", "SUCCESS", 100, 90, 10.0, ago(hours=i + 1)) for i in range(3)]
    assert ops.performance_degradation(runs(spark, base + worse), NOW).first().alert_message == "Data quality dropped by -10.0 percentage points"


def test_open_alerts_suppress_new_ones(spark):
    df = runs(spark, [("A", "FAILED", 100, 50, 30.0, ago(hours=2)), ("B", "FAILED", 100, 50, 30.0, ago(hours=2))])
    sla = ops.sla_dashboard(df, [Sla("ALL", "AVAILABILITY", "99", "<", "PERCENTAGE")], NOW)
    none = ops.performance_degradation(df, NOW)
    schema = "pipeline_name string, metric_name string, alert_type string, alert_status string, severity string, detected_at timestamp_ntz"
    held = [("A", "AVAILABILITY", "SLA_BREACH", "OPEN", "WARNING", ago(minutes=59)), ("B", "AVAILABILITY", "SLA_BREACH", "RESOLVED", "WARNING", ago(minutes=5))]
    assert [r.pipeline_name for r in ops.new_alerts(sla, none, spark.createDataFrame(held, schema), NOW).collect()] == ["B"]
    old = [("A", "AVAILABILITY", "SLA_BREACH", "OPEN", "WARNING", ago(minutes=61))]
    assert ops.new_alerts(sla, none, spark.createDataFrame(old, schema), NOW).count() == 2
