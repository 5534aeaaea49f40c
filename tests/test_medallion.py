from datetime import datetime

import pytest
from support import rows
from pyspark.sql import functions as F

from silverlode.catalog import DEFAULT
from silverlode.config import Catalog, ConfigError, Source, Target, UnknownSource
from silverlode.config import Column as SourceColumn
from silverlode.plans import medallion as med
from silverlode.plans.medallion import Medallion, PhaseFailed

HEADER = "ORDER_ID,CUSTOMER_ID,RESTAURANT_ID,ORDER_DATE,TOTAL_AMOUNT,ORDER_STATUS,PAYMENT_METHOD"
DAY = [datetime(2024, 1, d) for d in range(1, 10)]
FIRST = [
    "O1,C1,1,2024-01-01 10:00:00,100.55,placed,UPI",
    "O2,C1,2,2024-01-01 11:00:00,200.00,Placed ,Cash",
    'O3,"C2, Jr",3,2024-01-01 12:00:00,300.00,PLACED,UPI',
    ",C9,3,2024-01-01 12:00:00,300.00,PLACED,UPI",
    "O4,C2,x3,2024-01-01 12:00:00,300.00,PLACED,UPI",
    "O5,C2,3,2024-01-01 12:00:00,300.00,LOST,UPI",
    "O3,C2,3,2024-01-01 12:30:00,300.00,PLACED,UPI",
]
SECOND = ["O1,C1,1,2024-01-01 10:00:00,100.55,READY,UPI", "O2,C1,2,2024-01-01 11:00:00,200.00,PLACED,Cash", "O6,C3,2,2024-01-02 09:00:00,50.00,PLACED,UPI"]


def write(folder, name, lines, header=HEADER):
    path = folder / name
    path.write_text("\n".join([header, *lines]) + "\n")
    return str(path)


@pytest.fixture
def engine(spark, tmp_path):
    return Medallion(spark, str(tmp_path / "layers"), DEFAULT, buckets=3)


def test_one_batch_through_all_layers(engine, tmp_path):
    result = engine.run_files("ORDER_BATCH", "", write(tmp_path, "order_1.csv", FIRST), now=DAY[0], batch_id="B1")
    assert result.counts == {
        "source_rows": 7, "valid_rows": 3, "invalid_rows": 4, "silver_inserted": 3, "silver_updated": 0, "gold_inserted": 3, "gold_updated": 0,
    }
    bronze = {r.order_id_raw: r for r in engine.layer.read("order_brz").collect()}
    assert bronze["O4"].restaurant_id is None and bronze["O4"].restaurant_id_raw == "x3"
    assert str(bronze["O1"].total_amount) == "100.55" and bronze["O1"].order_date.hour == 10
    silver = {r.order_id: r for r in engine.layer.read("order_slv").collect()}
    assert set(silver) == {"O1", "O2", "O3"} and silver["O2"].order_status == "PLACED"
    errors = rows(engine.layer.read("order_load_error").select("error_id", "validate_column", "validation_type"))
    assert errors == rows(
        engine.spark.createDataFrame(
            [(None, "order_id", "MANDATORY_CHECK"), ("O4", "restaurant_id", "MANDATORY_CHECK"), ("O5", "order_status", "VALUE_CHECK"), ("O3", "order_id", "DUPLICATE_ALLOW_ONE_CHECK")],
            "a string, b string, c string",
        )
    )
    log = engine.runs().first()
    assert (log.run_status, log.source_row_count, log.valid_row_count, log.invalid_row_count) == ("SUCCESS", 7, 3, 4)
    assert engine.layer.read("dq_run_statistics").first().total_invalid_rows == 4


def test_second_batch_versions_changed_rows_only(engine, tmp_path):
    engine.run_files("ORDER_BATCH", "", write(tmp_path, "order_1.csv", FIRST), now=DAY[0], batch_id="B1")
    result = engine.run_files("ORDER_BATCH", "", write(tmp_path, "order_2.csv", SECOND), now=DAY[1], batch_id="B2")
    assert (result.ingest_run_id, result.counts["silver_inserted"], result.counts["silver_updated"]) == (2, 1, 2)
    assert (result.counts["gold_inserted"], result.counts["gold_updated"]) == (1, 1)
    gold = engine.layer.read("fact_order")
    assert gold.where("status = 'ACTIVE'").count() == 4
    one = gold.where("order_id = 'O1'").orderBy("eff_start_dt").collect()
    assert [(r.order_status, r.status, r.eff_start_dt.day, r.eff_end_dt.year, r.batch_id) for r in one] == [
        ("PLACED", "INACTIVE", 1, 2024, "B1"), ("READY", "ACTIVE", 2, 9999, "B2"),
    ]
    history = engine.layer.read("fact_order_status_history")
    assert rows(history.where("order_id = 'O1'").select("old_status", "new_status", "batch_id")) == [("PLACED", "READY", "B2"), (None, "PLACED", "B1")]


def test_finished_batch_is_skipped(engine, tmp_path):
    file = write(tmp_path, "order_1.csv", FIRST)
    engine.run_files("ORDER_BATCH", "", file, now=DAY[0], batch_id="B1")
    before = rows(engine.layer.read("fact_order"))
    assert engine.run_files("ORDER_BATCH", "", file, now=DAY[1], batch_id="B1").status == "SKIPPED"
    assert rows(engine.layer.read("fact_order")) == before


@pytest.mark.parametrize("broken", ["_to_gold", "_publish_silver", "_stage_transitions"])
def test_crash_between_phases_is_repaired_by_a_repeat(engine, tmp_path, monkeypatch, broken):
    files = [write(tmp_path, "order_1.csv", FIRST), write(tmp_path, "order_2.csv", SECOND)]
    engine.run_files("ORDER_BATCH", "", files[0], now=DAY[0], batch_id="B1")
    original = getattr(Medallion, broken)

    def crash(self, *args):
        if broken != "_to_gold":
            original(self, *args)
        raise OSError("executor lost")

    monkeypatch.setattr(Medallion, broken, crash)
    with pytest.raises(PhaseFailed):
        engine.run_files("ORDER_BATCH", "", files[1], now=DAY[1], batch_id="B2")
    assert engine.runs().where("run_status = 'FAILED'").count() == 1
    monkeypatch.undo()
    engine.run_files("ORDER_BATCH", "", files[1], now=DAY[1], batch_id="B2")

    clean = Medallion(engine.spark, str(tmp_path / "clean"), DEFAULT, buckets=3)
    for number, file in enumerate(files):
        clean.run_files("ORDER_BATCH", "", file, now=DAY[number], batch_id=f"B{number + 1}")
    for table in ("order_brz", "order_slv", "fact_order", "order_load_error", "fact_order_status_history"):
        left, right = engine.layer.read(table), clean.layer.read(table)
        assert rows(left.select(*right.columns)) == rows(right), table


def test_crash_while_gold_is_published(engine, tmp_path, monkeypatch):
    """The expired rows are published, the new ones are not: the repeat publishes the staged whole."""
    files = [write(tmp_path, "order_1.csv", FIRST), write(tmp_path, "order_2.csv", SECOND)]
    engine.run_files("ORDER_BATCH", "", files[0], now=DAY[0], batch_id="B1")
    original = med.Layer.replace_partitions

    def half(self, df, table, partition):
        if table == "fact_order":
            original(self, df.where("status = 'INACTIVE'"), table, partition)
            raise OSError("lost")
        original(self, df, table, partition)

    monkeypatch.setattr(med.Layer, "replace_partitions", half)
    with pytest.raises(PhaseFailed):
        engine.run_files("ORDER_BATCH", "", files[1], now=DAY[1], batch_id="B2")
    monkeypatch.undo()
    engine.run_files("ORDER_BATCH", "", files[1], now=DAY[1], batch_id="B2")
    gold = engine.layer.read("fact_order")
    assert gold.where("order_id = 'O1'").count() == 2
    assert gold.where("status = 'ACTIVE'").groupBy("order_id").count().where("count > 1").count() == 0


def test_repeat_keeps_what_another_batch_published(engine, tmp_path, monkeypatch):
    def order(name, state, number):
        return write(tmp_path, f"order_{number}.csv", [f"{name},C1,1,2024-01-01 10:00:00,5.00,{s},UPI" for name, s in zip(name, state)])

    files = [order(["O1"], ["PLACED"], 1), order(["O2"], ["PLACED"], 2), order(["O3", "O1"], ["PLACED", "READY"], 3)]

    def lost(self, *args):
        raise OSError("lost")

    engine.run_files("ORDER_BATCH", "", files[0], now=DAY[0], batch_id="B1")
    monkeypatch.setattr(Medallion, "_publish_silver", lost)
    with pytest.raises(PhaseFailed):
        engine.run_files("ORDER_BATCH", "", files[1], now=DAY[1], batch_id="B2")
    monkeypatch.undo()
    engine.run_files("ORDER_BATCH", "", files[2], now=DAY[2], batch_id="B3")
    engine.run_files("ORDER_BATCH", "", files[1], now=DAY[3], batch_id="B2")
    want = [("O1", "READY"), ("O2", "PLACED"), ("O3", "PLACED")]
    assert rows(engine.layer.read("order_slv").select("order_id", "order_status")) == want
    assert rows(engine.layer.read("fact_order").where("status = 'ACTIVE'").select("order_id", "order_status")) == want


def test_a_batch_that_follows_a_crashed_publish_carries_it_on(engine, tmp_path, monkeypatch):
    """Half of a publish, at most, is in the table when its driver dies; the next batch publishes the rest first."""
    files = [write(tmp_path, "order_1.csv", FIRST), write(tmp_path, "order_2.csv", SECOND), write(tmp_path, "order_3.csv", [SECOND[0].replace("READY", "DELIVERED"), "O7,C9,1,2024-01-03 10:00:00,7.00,PLACED,UPI"])]
    engine.run_files("ORDER_BATCH", "", files[0], now=DAY[0], batch_id="B1")
    original = med.Layer.replace_partitions

    def half(self, df, table, partition):
        if table == "order_slv":
            original(self, df.where("order_id <> 'O1'"), table, partition)
            raise OSError("lost")
        original(self, df, table, partition)

    monkeypatch.setattr(med.Layer, "replace_partitions", half)
    with pytest.raises(PhaseFailed):
        engine.run_files("ORDER_BATCH", "", files[1], now=DAY[1], batch_id="B2")
    monkeypatch.undo()
    engine.run_files("ORDER_BATCH", "", files[2], now=DAY[2], batch_id="B3")
    result = engine.run_files("ORDER_BATCH", "", files[1], now=DAY[3], batch_id="B2")
    assert (result.counts["valid_rows"], result.counts["silver_inserted"], result.counts["silver_updated"]) == (3, 1, 2)
    silver = {r.order_id: r.order_status for r in engine.layer.read("order_slv").collect()}
    assert silver == {"O1": "DELIVERED", "O2": "PLACED", "O3": "PLACED", "O6": "PLACED", "O7": "PLACED"}
    history = rows(engine.layer.read("fact_order_status_history").where("order_id = 'O1'").select("old_status", "new_status", "batch_id"))
    assert history == [("PLACED", "READY", "B2"), ("READY", "DELIVERED", "B3"), (None, "PLACED", "B1")]
    assert engine.layer.unpublished("order_slv") == engine.layer.unpublished("fact_order") == []


def test_statistics_of_sources_with_one_run_number(engine, tmp_path):
    header = "LOCATION_BRZ_ID,CITY,STATE,ZIP_CODE"
    engine.run_files("ORDER_BATCH", "", write(tmp_path, "order_1.csv", FIRST), now=DAY[0], batch_id="B1", run_id=5)
    engine.run_files("LOCATION_BATCH", "", write(tmp_path, "location_1.csv", ["1,Mumbai,Maharashtra,400001"], header), now=DAY[0], batch_id="L1", run_id=5)
    assert rows(engine.layer.read("dq_run_statistics").select("entity", "total_valid_rows")) == [("location", 1), ("order", 3)]
    assert engine.next_run_id() == 6


def test_expired_versions_of_a_batch_are_one_partition(engine, tmp_path):
    engine.run_files("ORDER_BATCH", "", write(tmp_path, "order_1.csv", FIRST), now=DAY[0], batch_id="B1")
    changed = [line.replace("placed", "ready").replace("Placed", "ready").replace("PLACED", "ready") for line in FIRST[:3]]
    engine.run_files("ORDER_BATCH", "", write(tmp_path, "order_2.csv", changed), now=DAY[1], batch_id="B2")
    gone = engine.layer.read("fact_order").where("status = 'INACTIVE'")
    assert rows(gone.select("expired_by", "key_bucket").distinct()) == [("B2", -1)] and gone.count() == 3


def test_repeated_and_missing_keys_do_not_multiply(engine, tmp_path):
    header = "LOCATION_BRZ_ID,CITY,STATE,ZIP_CODE"
    file = write(tmp_path, "location_1.csv", ["1,Mumbai,Maharashtra,400001", "1,Pune,Maharashtra,411001", ",Leh,Ladakh,194101"], header)
    for number in range(3):
        result = engine.run_files("LOCATION_BATCH", "", file, now=DAY[number], batch_id=f"L{number}")
    assert (result.counts["gold_inserted"], result.counts["gold_updated"]) == (0, 0)
    for table in ("location_slv", "dim_location"):
        assert [r.location_id for r in engine.layer.read(table).collect()] == [1], table
    assert engine.layer.read("location_load_error").count() == 6


def test_strict_load_aborts_and_reports_the_phase(engine, tmp_path):
    file = write(tmp_path, "order_1.csv", FIRST)
    with pytest.raises(PhaseFailed) as failure:
        engine.run_files("ORDER_BATCH", "", file, now=DAY[0], batch_id="B1", strict=True)
    assert failure.value.result.failed_phase == "STAGE_TO_BRONZE"
    assert not engine.layer.exists("order_slv")


def test_run_with_recovery(engine, tmp_path):
    file = write(tmp_path, "order_1.csv", FIRST)
    bad = engine.run_with_recovery("ORDER_BATCH", "", file, now=DAY[0], batch_id="B0", strict=True)
    assert bad.status == "FAILED"
    letter = engine.layer.read("dead_letter").first()
    assert (letter.error_type, letter.processing_status) == ("TECHNICAL", "PENDING") and "order_1.csv" in letter.record_data
    assert engine.layer.read("dead_letter").count() == 7
    assert engine.layer.read("alerts").first().severity == "CRITICAL"
    good = engine.run_with_recovery("ORDER_BATCH", "", file, now=DAY[1], batch_id="B1")
    log = engine.layer.read("reconciliation_log").orderBy("layer").collect()
    assert [(r.layer, r.source_count, r.target_count, r.reconciliation_status) for r in log] == [
        ("BRONZE->SILVER", 7, 3, "FAIL"), ("SILVER->GOLD", 3, 3, "FAIL"),
    ]
    assert engine.summary(good)["counts"]["valid_rows"] == 3


def test_other_entities_and_file_pattern(engine, tmp_path):
    places = tmp_path / "location"
    places.mkdir()
    header = "LOCATION_BRZ_ID,CITY,STATE,ZIP_CODE"
    write(places, "location_1.csv", ["1,Mumbai,Maharashtra,400001", "2,Leh,Ladakh,194101"], header)
    write(places, "notes.csv", ["9,X,Y,1"], header)
    engine.run_files("LOCATION_BATCH", str(tmp_path), now=DAY[0], batch_id="L1")
    gold = {r.city: (r.location_id, r.state_code, r.is_union_territory, r.city_tier) for r in engine.layer.read("dim_location").collect()}
    assert gold == {"Mumbai": (1, "MH", False, "TIER1"), "Leh": (2, "LA", True, "TIER3")}
    customers = tmp_path / "customer_1.csv"
    customers.write_text(
        'CUSTOMER_BRZ_ID,CUSTOMER_NAME,MOBILE,EMAIL,LOGIN_BY_USING,GENDER,DOB,ANNIVERSARY,PREFERENCES\n'
        '7, Ann ,99,A@X.COM ,GOOGLE,female,1990-02-03,,"{""spice_level"": ""hot"", ""favorite_cuisines"": [""Thai""]}"\n'
    )
    engine.run_files("CUSTOMER_BATCH", "", str(customers), now=DAY[0], batch_id="C1")
    row = engine.layer.read("dim_customer").first()
    assert (row.customer_name, row.email, row.gender, str(row.dob), row.anniversary) == ("Ann", "a@x.com", "FEMALE", "1990-02-03", None)
    assert row.preferences == '{"favorite_cuisines":["Thai"],"spice_level":"hot"}'


def test_empty_input(engine, tmp_path):
    result = engine.run_files("ORDER_BATCH", "", write(tmp_path, "order_0.csv", []), now=DAY[0], batch_id="B1")
    assert result.status == "SUCCESS" and result.counts == {"source_rows": 0}


def test_append_load_type(spark, tmp_path):
    target = Target("x_brz", "x_err", "x_slv", "x_gold", load_type="APPEND")
    source = Source(1, "X", "x", "BATCH", (SourceColumn("id", "raw", key=True), SourceColumn("v", "trim")), target)
    engine = Medallion(spark, str(tmp_path / "layers"), Catalog({"X": source}, {}), buckets=2)
    engine.run_files("X", "", write(tmp_path, "a.csv", ["1,a", "2,b"], "ID,V"), now=DAY[0], batch_id="B1")
    engine.run_files("X", "", write(tmp_path, "b.csv", ["2,changed", "3,c"], "ID,V"), now=DAY[1], batch_id="B2")
    assert rows(engine.layer.read("x_slv").select("id", "v")) == [("1", "a"), ("2", "b"), ("3", "c")]


def test_configuration_is_checked_by_name(engine):
    with pytest.raises(UnknownSource):
        engine.run_files("MYSTERY_BATCH", "/nowhere")
    with pytest.raises(ConfigError, match="SCD2"):
        Target("a", "b", "c", "d", load_type="SCD2")
    with pytest.raises(ConfigError, match="INCREMENTAL"):
        Source(1, "X", "x", "INCREMENTAL", (SourceColumn("id", key=True),), Target("a", "b", "c", "d"))
    with pytest.raises(ConfigError):
        Source(1, "X", "x", "BATCH", (SourceColumn("id"),), Target("a", "b", "c", "d"))
    mapping = DEFAULT.column_mapping()
    assert len({m[1] for m in mapping}) == 18
    names = ("source_id", "source_name", "ingestion_type", "format", "column_position", "column_name", "rule", "is_primary_key", "bronze_table", "silver_table", "gold_table", "load_type")
    listed = [dict(zip(names, m), entity=m[1].rsplit("_", 1)[0].lower(), load_error_table="e") for m in mapping]
    again = Catalog.from_rows(listed)
    assert again.source("ORDER_BATCH").names == DEFAULT.source("ORDER_BATCH").names
    assert again.source("ORDER_BATCH").keys == ["order_id"]


def test_batch_id_prefixes():
    assert med.new_batch_id("BATCH").startswith("BATCH_")
    assert med.new_batch_id("STREAM").startswith("STREAM_")
    assert med.new_batch_id("OTHER").startswith("GENERIC_")


def test_only_touched_buckets_are_rewritten(engine, tmp_path):
    engine.run_files("ORDER_BATCH", "", write(tmp_path, "order_1.csv", FIRST), now=DAY[0], batch_id="B1")
    batch = engine.layer.read("order_slv").where(F.col("order_id") == "O1")
    assert len(engine.layer.touched(batch, ["order_id"])) == 1


def test_letters_that_the_engine_wrote_are_run_again(engine, tmp_path):
    from silverlode.config import Retry

    file = write(tmp_path, "order_1.csv", FIRST)
    assert engine.run_with_recovery("ORDER_BATCH", "", file, now=DAY[0], batch_id="B0", strict=True).status == "FAILED"
    result = engine.retry_dead_letters("ORDER_BATCH", [Retry("ALL", "TECHNICAL", 2, 300)], now=DAY[1], batch_id="R1")
    assert (result.counts["source_rows"], result.counts["valid_rows"]) == (7, 3)
    states = {r.processing_status: r["count"] for r in engine.layer.read("dead_letter").groupBy("processing_status").count().collect()}
    assert sum(states.values()) == 7 and states["RESOLVED"] >= 3 and states["PENDING"] >= 1
    assert engine.layer.read("fact_order").count() == 3


def test_files_that_cannot_be_read_leave_one_letter(engine, tmp_path):
    missing = str(tmp_path / "nowhere.csv")
    assert engine.run_with_recovery("ORDER_BATCH", "", missing, now=DAY[0], batch_id="B9").status == "FAILED"
    letter = engine.layer.read("dead_letter").first()
    assert missing in letter.record_data and letter.dlq_id.startswith("B9-")


def test_dead_letters_are_run_again_as_one_batch(engine):
    from silverlode.config import Retry

    def payload(order, restaurant):
        return (
            f'{{"order_id": "{order}", "customer_id": "C1", "restaurant_id": "{restaurant}", "order_date": "2024-01-01 10:00:00", '
            f'"total_amount": "10.00", "order_status": "PLACED", "payment_method": "UPI"}}'
        )

    letters = engine.spark.createDataFrame(
        [
            (1, "ORDER_BATCH", "TECHNICAL", payload("O1", 3), "PENDING", 0, None, DAY[0]),
            (2, "ORDER_BATCH", "TECHNICAL", payload("O2", "none"), "PENDING", 0, None, DAY[0]),
            (3, "ORDER_BATCH", "TECHNICAL", "no json", "PENDING", 1, DAY[0], DAY[0]),
            (4, "DELIVERY_BATCH", "TECHNICAL", "{}", "PENDING", 0, None, DAY[0]),
        ],
        """dlq_id int, pipeline_name string, error_type string, record_data string, processing_status string, retry_count int,
           last_retry_at timestamp_ntz, created_at timestamp_ntz""",
    )
    result, queue = engine.retry_letters("ORDER_BATCH", letters, [Retry("ALL", "TECHNICAL", 2, 300)], now=DAY[1], batch_id="R1")
    assert (result.counts["source_rows"], result.counts["valid_rows"]) == (3, 1)
    found = {r.dlq_id: (r.processing_status, r.retry_count) for r in queue.collect()}
    assert found == {1: ("RESOLVED", 1), 2: ("PENDING", 1), 3: ("ABANDONED", 2), 4: ("PENDING", 0)}
    assert [r.order_id for r in engine.layer.read("fact_order").collect()] == ["O1"]
