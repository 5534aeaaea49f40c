import json
import os
from datetime import datetime, timedelta

import pytest
from support import rows
from pyspark.sql import functions as F

from silverlode.catalog import DEFAULT
from silverlode.plans.medallion import Medallion
from silverlode.streaming import events as ev
from silverlode.streaming import jobs, monitors

START = datetime(2024, 1, 1, 10)
STATES = ["PLACED", "CONFIRMED", "PREPARING", "READY"]


def order_event(order, minute, status, amount=100.5, **extra):
    at = (START + timedelta(minutes=minute)).isoformat()
    body = {
        "event_type": "ORDER_UPDATED", "event_timestamp": at, "order_id": order, "customer_id": 7, "restaurant_id": 3,
        "order_date": START.isoformat(), "total_amount": amount, "order_status": status, "payment_method": "UPI", **extra,
    }
    return message("orders-events", order, json.dumps(body), minute)


def message(topic, key, value, minute):
    stamp = int((START + timedelta(minutes=minute) - datetime(1970, 1, 1)).total_seconds() * 1000)
    return json.dumps({"topic": topic, "partition": 0, "offset": minute, "timestamp_ms": stamp, "key": key, "value": value})


def write_files(folder, batches):
    folder.mkdir(exist_ok=True)
    for number, lines in enumerate(batches):
        file = folder / f"part-{number:03d}.json"
        file.write_text("\n".join(lines) + "\n")
        # The source reads files in the order of their times.
        os.utime(file, (1_700_000_000 + number, 1_700_000_000 + number))


LIFE = [order_event(f"O{o}", o + 10 * step, status) for step, status in enumerate(STATES) for o in range(4)]


def run_stream(spark, tmp_path, name, folder, per_batch, **options):
    engine = Medallion(spark, str(tmp_path / f"layers-{name}"), DEFAULT, buckets=2)
    messages = ev.file_messages(spark, str(folder), per_batch)
    jobs.stream_to_gold(engine, "ORDER_STREAM", messages, str(tmp_path / f"check-{name}"), name, **options).awaitTermination()
    return engine


def state(engine):
    silver = engine.layer.read("order_slv").select("order_id", "order_status", "event_ts")
    gold = engine.layer.read("fact_order").where("status = 'ACTIVE'").select("order_id", "order_status", "customer_id", "total_amount")
    return rows(silver), rows(gold)


def test_micro_batches_equal_one_batch(spark, tmp_path):
    write_files(tmp_path / "many", [LIFE[:6], LIFE[6:12], LIFE[12:]])
    write_files(tmp_path / "one", [LIFE])
    many = run_stream(spark, tmp_path, "many", tmp_path / "many", 1)
    one = run_stream(spark, tmp_path, "one", tmp_path / "one", 10)
    assert state(many) == state(one)
    history = [rows(e.layer.read("fact_order_status_history").drop("batch_id").select("order_id", "old_status", "new_status", "status_changed_at")) for e in (many, one)]
    assert history[0] == history[1] and len(history[0]) == 16
    assert {r[1] for r in state(one)[0]} == {"READY"}


def test_bad_repeated_and_late_messages(spark, tmp_path):
    late = order_event("O1", 5, "CONFIRMED")
    batches = [
        [*LIFE, '{"topic": "orders-events", "value": "{\\"test\\"', message("orders-events", None, '{"test": "connection"}', 1)],
        LIFE,
        [late, order_event("O9", 1, "PLACED")],
    ]
    write_files(tmp_path / "in", batches)
    engine = run_stream(spark, tmp_path, "rough", tmp_path / "in", 1)
    final = {r[0]: r[1] for r in state(engine)[0]}
    assert final == {"O0": "READY", "O1": "READY", "O2": "READY", "O3": "READY", "O9": "PLACED"}
    letters = engine.layer.read("stream_dead_letter")
    assert letters.count() == 2 and letters.where("processing_status = 'PENDING'").count() == 2
    gold = engine.layer.read("fact_order")
    assert gold.where("order_id = 'O1'").count() == 1


def test_letters_of_a_stream_are_run_again_and_settled(spark, tmp_path):
    """A message whose text was mended in its letter reaches Gold; one that stays bad is counted as tried."""
    from silverlode.config import Retry

    write_files(tmp_path / "in", [[*LIFE[:4], message("orders-events", "x", "no json", 50), message("orders-events", "y", "", 51)]])
    engine = run_stream(spark, tmp_path, "letters", tmp_path / "in", None)
    table = f"stream_{jobs.DEAD_LETTERS}"
    letters = engine.layer.read(table)
    assert letters.count() == 2 and letters.select("dlq_id").distinct().count() == 2 and letters.where("last_retry_at IS NOT NULL").count() == 0
    good = json.dumps({"order_id": "O99", "customer_id": "7", "restaurant_id": "3", "order_date": "2024-01-01 10:00:00", "total_amount": "5.00", "order_status": "PLACED", "payment_method": "UPI"})
    mended = letters.withColumn("record_data", F.when(F.col("record_data") == "no json", good).otherwise(F.col("record_data")))
    engine.layer.replace_partitions(spark.createDataFrame(mended.collect(), mended.schema), table, ["batch_id"])
    result = engine.retry_dead_letters("ORDER_STREAM", [Retry("ALL", "TRANSFORMATION", 2, 300)], table, now=datetime(2024, 1, 3), batch_id="R1")
    assert result.status == "SUCCESS" and engine.layer.read("fact_order").where("order_id = 'O99'").count() == 1
    states = sorted((r.processing_status, r.retry_count) for r in engine.layer.read(table).collect())
    assert states == [("PENDING", 1), ("RESOLVED", 1)]


def test_delivered_again_epoch_changes_nothing(spark, tmp_path):
    write_files(tmp_path / "in", [LIFE])
    engine = run_stream(spark, tmp_path, "again", tmp_path / "in", 10)
    before = rows(engine.layer.read("fact_order")), engine.runs().count()
    batch = ev.file_messages(spark, str(tmp_path / "in"), stream=False)
    jobs.run_batches(engine, "ORDER_STREAM", "again")(batch, 0)
    assert (rows(engine.layer.read("fact_order")), engine.runs().count()) == before


def test_bounded_removal_of_repeats(spark, tmp_path):
    write_files(tmp_path / "in", [LIFE, LIFE])
    messages = jobs.once_per_message(ev.file_messages(spark, str(tmp_path / "in"), 1))
    jobs.land(messages, str(tmp_path / "landing"), str(tmp_path / "check")).awaitTermination()
    landed = spark.read.parquet(str(tmp_path / "landing"))
    assert landed.count() == len(LIFE)
    assert {"topic", "partition", "offset", "kafka_timestamp", "key", "value", "ingested_at"} == set(landed.columns)


def test_landing_reads_only_what_is_new(spark, tmp_path):
    folder = tmp_path / "in"
    write_files(folder, [LIFE[:4]])
    for expected in (4, 4, 16):
        if expected == 16:
            (folder / "more.json").write_text("\n".join(LIFE[4:]) + "\n")
        jobs.land(ev.file_messages(spark, str(folder)), str(tmp_path / "landing"), str(tmp_path / "check")).awaitTermination()
        assert spark.read.parquet(str(tmp_path / "landing")).count() == expected


def test_field_names_in_either_case_and_both_status_fields(spark):
    values = [
        '{"order_id": "a", "status": "PLACED", "event_timestamp": "2024-01-01T10:00:00"}',
        '{"ORDER_ID": "b", "ORDER_STATUS": "READY", "TOTAL_AMOUNT": "12.5"}',
        '{"order_id": "c", "total_amount": "n/a"}',
        "not json",
    ]
    df = spark.createDataFrame([("orders-events", 0, i, v) for i, v in enumerate(values)], "topic string, partition int, offset long, value string")
    typed = ev.typed_events(df.withColumn("kafka_timestamp", F.current_timestamp()), "order")
    assert sorted((r.order_id, r.order_status, r.total_amount and float(r.total_amount)) for r in typed.collect()) == [("a", "PLACED", None), ("b", "READY", 12.5), ("c", None, None)]


@pytest.mark.parametrize(
    "entity, value, expected",
    [
        ("order_item", {"order_item_id": "i", "order_id": "o", "menu_id": 5, "quantity": 2, "price": 1.5, "subtotal": 3.0}, {"menu_id": 5, "quantity": 2}),
        ("delivery", {"delivery_id": "d", "order_id": "o", "estimated_time": 30, "location": {"latitude": 1.5}}, {"estimated_time": "30", "location": '{"latitude":1.5}'}),
    ],
)
def test_other_topics(spark, entity, value, expected):
    df = spark.createDataFrame([(ev.TOPICS[entity], 0, 1, json.dumps(value))], "topic string, partition int, offset long, value string")
    row = ev.typed_events(df.withColumn("kafka_timestamp", F.current_timestamp()), entity).first().asDict()
    assert {k: row[k] for k in expected} == expected


def test_windows_are_the_same_in_batch_and_stream(spark, tmp_path):
    write_files(tmp_path / "in", [[order_event(f"O{m}", m, "PLACED") for m in range(90)]])
    messages = ev.file_messages(spark, str(tmp_path / "in"), stream=False)
    batch = jobs.windowed(messages, "kafka_timestamp", "10 minutes")
    stream = ev.file_messages(spark, str(tmp_path / "in"))
    jobs.windowed_to_table(stream, "kafka_timestamp", "10 minutes", str(tmp_path / "w"), str(tmp_path / "c")).awaitTermination()
    finished = rows(spark.read.parquet(str(tmp_path / "w")))
    assert finished == rows(batch)[: len(finished)] and len(finished) == 7


def test_progress_of_a_query(spark, tmp_path):
    write_files(tmp_path / "in", [LIFE])
    query = jobs.land(ev.file_messages(spark, str(tmp_path / "in")), str(tmp_path / "l"), str(tmp_path / "c"))
    query.awaitTermination()
    (component, status, details), = jobs.progress(query)
    assert component == "Streaming query" and status == "✗ Stopped" and "rows" in details


def test_alert_limits(spark):
    rows_ = spark.range(1001).toDF("id")
    assert monitors.backlog_alert(rows_).first().alert_status.startswith("🚨")
    assert monitors.backlog_alert(rows_.where("id > 0")).first().alert_status == monitors.OK
