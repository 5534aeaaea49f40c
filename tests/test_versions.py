from datetime import datetime

from support import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from silverlode.functions.scalar import as_timestamp, row_hash
from silverlode.operators import dims, history, merge, scd2

SCHEMA = "id string, v string, event_ts timestamp_ntz"
T1, T2, T3 = (datetime(2024, 1, d) for d in (1, 2, 3))


def batch(spark, data, number=1):
    return merge.stamp(spark.createDataFrame(data, SCHEMA), f"B{number}", as_timestamp(f"2024-02-0{number}"))


def test_upsert_keeps_created_at_and_replaces_values(spark):
    target = batch(spark, [("a", "1", T1), ("b", "1", T1)])
    result = merge.upsert(target, batch(spark, [("b", "2", T2), ("c", "2", T2)], 2), ["id"])
    found = {r.id: (r.v, r.batch_id, r.created_at.day, r.updated_at.day) for r in result.collect()}
    assert found == {"a": ("1", "B1", 1, 1), "b": ("2", "B2", 1, 2), "c": ("2", "B2", 2, 2)}


def test_older_events_do_not_replace_newer_ones(spark):
    target = batch(spark, [("a", "new", T2), ("b", "old", T2), ("c", "none", None)])
    late = batch(spark, [("a", "late", T1), ("b", "later", T3), ("c", "first", T1)], 2)
    result = merge.upsert(target, late, ["id"], newest_by="event_ts")
    assert {r.id: r.v for r in result.collect()} == {"a": "new", "b": "later", "c": "first"}


def test_append_absent(spark):
    target = batch(spark, [("a", "1", T1)])
    assert [r.id for r in merge.append_absent(target, batch(spark, [("a", "2", T1), ("b", "2", T1)], 2), ["id"]).collect()] == ["b"]


def test_latest_per_key(spark):
    df = spark.createDataFrame([("a", "1", T1), ("a", "2", T3), ("a", "3", T2), ("b", None, None)], SCHEMA)
    assert rows(merge.latest_per_key(df, ["id"], ["event_ts"]).select("id", "v")) == [("a", "2"), ("b", None)]


keys = st.sampled_from(["a", "b", "c", "d"])
batches = st.dictionaries(keys, st.sampled_from(["1", "2", None]), max_size=4)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batches, batches)
def test_upsert_is_idempotent(spark, first, second):
    target = batch(spark, [(k, v, T1) for k, v in first.items()])
    change = batch(spark, [(k, v, T2) for k, v in second.items()], 2)
    once = merge.upsert(target, change, ["id"])
    assert rows(merge.upsert(once, change, ["id"])) == rows(once)
    assert {r.id for r in once.collect()} == set(first) | set(second)


def versions_after(spark, steps):
    """All versions after applying ``steps`` (dicts of id to value) one after another."""
    kept, active = [], None
    for number, step in enumerate(steps, start=1):
        now = as_timestamp(datetime(2024, 3, number))
        df = spark.createDataFrame(list(step.items()), "id string, v string")
        if active is None:
            hashed = df.withColumn("row_hash", row_hash(["id", "v"])).withColumn("scd_action", F.lit("INSERT"))
            after = scd2.new_versions(hashed, batch_id="B1", now=now)
        else:
            staged = scd2.detect_changes(active, df, ["id"], ["id", "v"])
            after = scd2.apply_changes(active, staged, ["id"], batch_id=f"B{number}", now=now)
        data = after.collect()
        kept += [r for r in data if r.status == "INACTIVE"]
        active = spark.createDataFrame([r for r in data if r.status == "ACTIVE"], after.schema)
    return kept, active.collect()


def test_insert_update_unchanged_repeat_and_second_change(spark):
    first = {"a": "1", "b": "1", "c": "1"}
    change = {"b": "2", "d": "1"}
    kept, active = versions_after(spark, [first, change, change, {"b": "3"}, {"b": "1"}])
    assert {r.id: r.v for r in active} == {"a": "1", "b": "1", "c": "1", "d": "1"}
    history_of_b = sorted((r.eff_start_dt.day, r.eff_end_dt.day, r.v) for r in kept)
    assert history_of_b == [(1, 2, "1"), (2, 4, "2"), (4, 5, "3")]
    assert all(r.id == "b" for r in kept)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.dictionaries(keys, st.sampled_from(["1", "2"]), min_size=1, max_size=4), min_size=2, max_size=3))
def test_versions_never_overlap(spark, steps):
    kept, active = versions_after(spark, steps)
    assert len({r.id for r in active}) == len(active)
    for key in {r.id for r in active}:
        spans = sorted((r.eff_start_dt, r.eff_end_dt) for r in [*kept, *active] if r.id == key)
        assert all(left[1] == right[0] for left, right in zip(spans, spans[1:]))
        assert str(spans[-1][1]) == scd2.OPEN_END


def test_transitions_and_current_state(spark):
    events = spark.createDataFrame(
        [("o", "PLACED", T1, 1), ("o", "PLACED", T2, 2), ("o", "READY", T3, 3), ("p", "READY", T1, 4)],
        "id string, s string, at timestamp_ntz, n int",
    )
    changes = history.transitions(events, "id", "s", "at", ["n"])
    assert rows(changes.select("id", "old_status", "new_status")) == rows(
        spark.createDataFrame([("o", None, "PLACED"), ("o", "PLACED", "READY"), ("p", None, "READY")], "a string, b string, c string")
    )
    known = spark.createDataFrame([("p", "READY"), ("o", "NEW")], "id string, s string")
    seeded = history.transitions(events, "id", "s", "at", ["n"], known)
    assert {tuple(r) for r in seeded.select("id", "old_status", "new_status").collect()} == {("o", "NEW", "PLACED"), ("o", "PLACED", "READY")}
    state = {r.id: (r.current_status, r.initial_status) for r in history.current_state(events, "id", "s", "at", ["n"]).collect()}
    assert state == {"o": ("READY", "PLACED"), "p": ("READY", "READY")}


def test_calendar_is_inclusive_and_uses_iso_weekdays(spark):
    bounds = spark.sql("SELECT DATE'2023-12-30' AS first_day, DATE'2024-01-01' AS last_day")
    days = dims.date_dimension(bounds).orderBy("calendar_date").collect()
    assert [(str(d.calendar_date), d.day_of_week, d.week, d.day_name) for d in days] == [
        ("2023-12-30", 6, 52, "Sat"), ("2023-12-31", 7, 52, "Sun"), ("2024-01-01", 1, 1, "Mon"),
    ]
    assert len({d.dim_date_hk for d in days}) == 3


def test_location_enrichment(spark):
    df = spark.createDataFrame([(" mumbai ", "maharashtra"), ("Kochi", "Kerala"), ("Nowhere", None)], "city string, state string")
    found = [tuple(r)[2:] for r in dims.enrich_location(df).collect()]
    assert sorted(found, key=repr) == sorted(
        [("MH", False, True, "TIER1"), ("KL", False, False, "TIER2"), (None, False, False, "TIER3")], key=repr
    )
