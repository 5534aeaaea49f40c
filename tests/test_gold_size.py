"""The Gold step moves either side of a batch once, and no hash that it can work out behind the move."""

import re
from datetime import datetime

from pyspark.sql import functions as F

from silverlode.functions.scalar import as_timestamp, row_hash
from silverlode.operators import scd2
from silverlode.plans.medallion import Medallion
from silverlode.sources.tables import BUCKET, Layer

TRACKED = ["id", "v", "w"]


def on(day):
    return as_timestamp(datetime(2024, 3, day))


def opened(spark, values):
    df = spark.createDataFrame(values, "id string, v string, w int").withColumn(BUCKET, F.lit(0))
    return scd2.new_versions(df.withColumn("row_hash", row_hash(TRACKED)).withColumn("scd_action", F.lit("INSERT")), batch_id="B1", now=on(1))


def test_one_join_equals_changes_detected_and_applied(spark, as_rows):
    active = opened(spark, [("a", "1", 1), ("b", "|", None), ("c", None, 3), ("d", "", None)])
    batch = spark.createDataFrame([("b", "|", None), ("c", "2", 3), ("d", None, None), ("e", "\\", 5)], "id string, v string, w int").withColumn(BUCKET, F.lit(0))
    staged = scd2.detect_changes(active, batch, ["id"], TRACKED)
    before = scd2.apply_changes(active, staged, ["id"], batch_id="B2", now=on(2))
    after = scd2.unpack_hash(scd2.versions_after(active, batch, ["id"], TRACKED, batch_id="B2", now=on(2)), TRACKED)
    assert after.columns == before.columns and after.dtypes == before.dtypes
    assert as_rows(after) == as_rows(before) and after.count() == 6


def test_gold_is_staged_with_one_move_a_side(spark, tmp_path, monkeypatch):
    from silverlode.catalog import DEFAULT

    plans, stage = {}, Layer.stage

    def seen(layer, df, table, batch_id, *rest):
        plans[table, batch_id] = df._jdf.queryExecution().executedPlan().toString()
        return stage(layer, df, table, batch_id, *rest)

    monkeypatch.setattr(Layer, "stage", seen)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        engine, source = Medallion(spark, str(tmp_path / "layers"), DEFAULT, buckets=2), DEFAULT.source("ORDER_BATCH")
        for day, status in enumerate(("pending", "completed"), 1):
            names = {n: F.lit(None).cast("string") for n in source.names}
            given = {
                "order_id": F.concat(F.lit("O"), F.col("id").cast("string")), "customer_id": F.lit("7"), "restaurant_id": F.lit("3"),
                "order_date": F.lit("2024-01-01 10:00:00"), "total_amount": F.lit("5.00"), "order_status": F.lit(status), "payment_method": F.lit("UPI"),
            }
            texts = spark.range(20).select(*[v.alias(n) for n, v in (names | given).items()])
            result = engine.run_rows(source, lambda: texts, batch_id=f"B{day}", now=datetime(2024, 1, day))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert (result.counts["gold_inserted"], result.counts["gold_updated"]) == (0, 20), result.counts
    gold = engine.layer.read("fact_order")
    assert gold.where(F.col("row_hash") == row_hash(source.silver_names)).count() == gold.count() == 40
    assert len(re.findall(r"Exchange hashpartitioning", plans["fact_order", "B2"])) == 2


def test_hashes_are_neither_moved_nor_staged_and_a_stale_one_still_counts(spark, as_rows):
    active = opened(spark, [("a", "1", 1), ("b", "2", 2), ("c", "3", 3), ("d", None, 4)])
    active = active.withColumn("row_hash", F.when(F.col("id") == "c", F.sha2(F.lit("of other values"), 256)).otherwise(F.col("row_hash")))
    batch = spark.createDataFrame([("b", "2", 2), ("c", "3", 3), ("d", "4", 4), ("e", "5", 5)], "id string, v string, w int").withColumn(BUCKET, F.lit(0))
    staged = scd2.versions_after(active, batch, ["id"], TRACKED, batch_id="B2", now=on(2))
    assert [(r.id, r.status) for r in staged.where("row_hash IS NOT NULL").collect()] == [("c", "INACTIVE")]
    before = scd2.apply_changes(active, scd2.detect_changes(active, batch, ["id"], TRACKED), ["id"], batch_id="B2", now=on(2))
    assert as_rows(scd2.unpack_hash(staged, TRACKED)) == as_rows(before) and before.count() == 7
