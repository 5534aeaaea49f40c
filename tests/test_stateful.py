"""Keyed state and stream joins: late, repeated and shuffled events, and restarts from the checkpoint."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from support import rows

from silverlode.operators import history
from silverlode.streaming import jobs, stateful

START = datetime(2024, 1, 1)
EVENTS = "order_id string, status string, at timestamp, seq long"


def moment(minutes):
    return START + timedelta(minutes=minutes)


def events(hot=150):
    """Keys with few events, one key with a third of all, equal moments, NULL statuses and NULL times."""
    rng = random.Random(8)
    made, seq = [], 0
    for order in range(40):
        for _ in range(rng.randrange(1, 20) if order else hot):
            seq += 1
            made.append((f"O{order}", rng.choice(["PLACED", "READY", "GONE"]), moment(rng.randrange(500)), seq))
    return [*made, ("O1", "READY", moment(77), 9001), ("O1", "PLACED", moment(77), 9002), ("O2", "READY", None, 9003)]


def run(stream, tmp_path, mode="append"):
    table = str(tmp_path / "table")
    if mode == "append":
        writer = stream.writeStream.format("parquet").option("path", table)
    else:
        writer = stream.writeStream.outputMode(mode).foreachBatch(lambda batch, epoch: batch.write.mode("append").parquet(table))
    jobs._start(writer.option("checkpointLocation", str(tmp_path / "checkpoint")), None).awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(table)


@pytest.mark.parametrize("states", [False, True])
def test_history_over_restarts_equals_the_batch_operator(spark, tmp_path, states):
    made, source = events(), str(tmp_path / "source")
    random.Random(1).shuffle(made)
    make = stateful.current_states if states else stateful.status_history
    # each part is a run of its own; the second repeats some of the first, the last only moves the watermark
    for part in (made[: len(made) // 2], made[len(made) // 2 :] + made[:50], [(None, None, moment(10**6), 0)]):
        spark.createDataFrame(part, EVENTS).repartition(3).write.mode("append").parquet(source)
        stream = make(spark.readStream.schema(EVENTS).parquet(source), "order_id", "status", "at", "seq", late="600 minutes")
        found = run(stream, tmp_path, "update" if states else "append")
    whole = spark.createDataFrame([e for e in made if e[2]], EVENTS)
    if states:
        want = history.current_state(whole, "order_id", "status", "at", ["seq"])
        got = stateful.last_states(found, "order_id").select(want.columns)
    else:
        want = history.transitions(whole, "order_id", "status", "at", ["seq"])
        got = found.select(want.columns)
    assert rows(got) == rows(want) and want.count() >= 40


def test_events_behind_the_watermark_are_dropped_and_order_within_it_is_kept(spark, tmp_path):
    source = str(tmp_path / "source")
    for part in ([("A", "READY", moment(30), 1), ("A", "PLACED", moment(10), 2)], [("A", "GONE", moment(60), 3)], [("A", "LOST", moment(5), 4), (None, None, moment(9999), 5)]):
        spark.createDataFrame(part, EVENTS).coalesce(1).write.mode("append").parquet(source)
        stream = stateful.status_history(spark.readStream.schema(EVENTS).parquet(source), "order_id", "status", "at", "seq", late="10 minutes")
        found = run(stream, tmp_path)
    got = [(r.old_status, r.new_status) for r in found.where("order_id IS NOT NULL").orderBy("status_changed_at").collect()]
    assert got == [(None, "PLACED"), ("PLACED", "READY"), ("READY", "GONE")]


def test_quiet_keys_are_forgotten(spark, tmp_path):
    """With ``forget`` a key that was quiet for long enough starts anew."""
    source = str(tmp_path / "source")
    parts = [[("A", "PLACED", moment(0), 1), ("B", "PLACED", moment(0), 2)], [("B", "READY", moment(50), 3), (None, None, moment(200), 4)], [(None, None, moment(300), 5)], [("A", "READY", moment(400), 6), (None, None, moment(9999), 7)]]
    for part in parts:
        spark.createDataFrame(part, EVENTS).coalesce(1).write.mode("append").parquet(source)
        stream = stateful.status_history(spark.readStream.schema(EVENTS).parquet(source), "order_id", "status", "at", "seq", "10 minutes", timedelta(minutes=60))
        found = run(stream, tmp_path)
    got = sorted(tuple(r)[:3] for r in found.where("order_id IS NOT NULL").collect() for r in [(r.order_id, r.new_status, r.old_status)])
    assert got == [("A", "PLACED", None), ("A", "READY", None), ("B", "PLACED", None), ("B", "READY", "PLACED")]


ORDERS, ITEMS = "order_id string, total_amount double, order_status string, at timestamp", "order_id string, at timestamp"


def test_orders_without_partners_equal_the_anti_join(spark, tmp_path):
    """Partners before, after, repeated, too late and never; a third of all items belong to one order."""
    rng = random.Random(3)
    orders = [(f"O{k}", float(k), rng.choice(["PLACED", "CANCELLED", None]), moment(k)) for k in range(200)]
    items = [(f"O{rng.randrange(0, 300)}", moment(rng.randrange(0, 260))) for _ in range(300)] + [("O7", moment(9 + k / 100)) for k in range(150)] + [(None, moment(3))]
    for name, made, schema in (("orders", orders, ORDERS), ("items", items, ITEMS)):
        spark.createDataFrame(made, schema).repartition(3).write.parquet(str(tmp_path / name))
        end = ("end", moment(10**5)) if name == "items" else ("end", None, None, moment(10**5))
        spark.createDataFrame([end], schema).write.mode("append").parquet(str(tmp_path / name))
    read = lambda name, schema: spark.readStream.schema(schema).parquet(str(tmp_path / name))
    options = {"late": "300 minutes", "before": "20 minutes"}
    (tmp_path / "a").mkdir()
    (tmp_path / "b").mkdir()
    found = run(stateful.orders_without_items(read("orders", ORDERS), read("items", ITEMS), "at", "at", "60 minutes", **options), tmp_path / "a")
    near = lambda o: any(i == o[0] and o[3] - timedelta(minutes=20) <= at <= o[3] + timedelta(minutes=60) for i, at in items)
    want = [(o[0], o[1], 0) for o in orders if not near(o)]
    assert rows(found) == sorted(want, key=repr) and 0 < len(want) < 200
    found = run(stateful.orders_without_delivery(read("orders", ORDERS), read("items", ITEMS), "at", "at", "60 minutes", **options), tmp_path / "b")
    assert sorted(r.order_id for r in found.collect()) == sorted(o[0] for o in orders if o[2] == "PLACED" and not near(o))


def test_windows_are_exact_on_a_stream(spark, tmp_path):
    """The same rows of one function over a frame and over a stream of it, over a restart."""
    rng = random.Random(5)
    schema = "id string, buyer long, amount decimal(12,2), at timestamp"
    made = [(f"o{rng.randrange(60)}", rng.choice([None, 1, 2, 3, rng.randrange(500)]), rng.choice([None, 1, 2.5]), moment(rng.randrange(300))) for _ in range(900)]
    made = [(i, b, None if a is None else __import__("decimal").Decimal(a), at) for i, b, a, at in made]
    source = str(tmp_path / "source")
    arguments = {"amount": "amount", "distinct": {"ids": "id", "buyers": "buyer"}, "late": "400 minutes"}
    for part in (made[:500], made[500:], [(None, None, None, moment(10**5))]):
        spark.createDataFrame(part, schema).repartition(2).write.mode("append").parquet(source)
        found = run(jobs.windowed(spark.readStream.schema(schema).parquet(source), "at", "10 minutes", **arguments), tmp_path)
    frame = spark.createDataFrame(made, schema)
    batch = jobs.windowed(frame, "at", "10 minutes", **arguments)
    assert rows(found) == rows(batch) and found.schema == batch.schema
    plain = frame.groupBy(F.window("at", "10 minutes").start.alias("window_start")).agg(
        F.count("*"), F.sum("amount"), F.sum("amount").cast("double") / F.count("amount"), F.count_distinct("id"), F.count_distinct("buyer"))
    assert rows(batch) == rows(plain)


def test_a_batch_of_a_key_is_put_by_with_one_call():
    """Calls of the state grow with batches, not with events."""
    from types import SimpleNamespace

    calls = []

    class State:
        def __init__(self):
            self.held = None

        def __getattr__(self, name):
            def call(*given):
                calls.append(name)
                if name == "appendList":
                    self.held = [*(self.held or []), *given[0]]
                elif name in ("update", "put"):
                    self.held = given[0]
                elif name == "clear":
                    self.held = None
                return self.held is not None if name == "exists" else iter(self.held) if name == "get" else None

            return call

    handle = SimpleNamespace(getValueState=lambda *_: State(), getListState=lambda *_: State(), getMapState=lambda *_: State(), registerTimer=lambda _: None)
    keyed = stateful._Statuses(False, None)
    keyed.init(handle)
    events = [SimpleNamespace(at=k // 2 * 1000, tie=k // 2, status="AB"[k // 20 % 2]) for k in range(200)]
    list(keyed.handleInputRows(("k",), iter(events), None))
    assert len(calls) == 1
    out = list(keyed.handleExpiredTimer(("k",), SimpleNamespace(getCurrentWatermarkInMs=lambda: 10_000), None))
    assert len(calls) < 8
    assert [r.new_status for r in out] == ["A", "B"] * 5 and [r.status_changed_at for r in out] == [k * 10_000 for k in range(10)]
