"""A batch is staged and published by groups of buckets; each group moves either side once."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from support import rows

from silverlode.catalog import DEFAULT
from silverlode.functions.scalar import as_timestamp, plain_columns, row_text, texts_differ
from silverlode.operators import merge
from silverlode.plans.medallion import Medallion
from silverlode.sources import tables
from silverlode.sources.tables import Layer


def loaded(spark, root, buckets=4):
    engine, source = Medallion(spark, str(root), DEFAULT, buckets=buckets), DEFAULT.source("ORDER_BATCH")
    for day, (status, orders) in enumerate((("pending", 30), ("completed", 40)), 1):
        given = {
            "order_id": F.concat(F.lit("O"), F.col("id").cast("string")), "customer_id": F.lit("7"), "restaurant_id": F.lit("3"),
            "order_date": F.lit("2024-01-01 10:00:00"), "total_amount": F.lit("5.00"), "order_status": F.lit(status), "payment_method": F.lit("UPI"),
        }
        texts = spark.range(orders).select(*[given[n].alias(n) for n in source.names])
        result = engine.run_rows(source, lambda: texts, batch_id=f"B{day}", now=datetime(2024, 1, day))
    return engine, result


def test_a_large_batch_moves_a_group_of_buckets_at_a_time(spark, tmp_path, monkeypatch):
    whole, expected = loaded(spark, tmp_path / "whole")
    plans, written, stage, replace = {}, {}, Layer.stage, Layer.replace_partitions

    def staged(layer, df, table, batch_id, *rest):
        plans.setdefault((table, batch_id), []).append(df._jdf.queryExecution().executedPlan().toString())
        return stage(layer, df, table, batch_id, *rest)

    def published(layer, df, table, partition):
        written.setdefault(table, []).append({r[0] for r in df.select(partition[-1]).distinct().collect()})
        return replace(layer, df, table, partition)

    monkeypatch.setattr(Layer, "stage", staged)
    monkeypatch.setattr(Layer, "replace_partitions", published)
    monkeypatch.setattr(tables, "GROUP_BYTES", 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        engine, result = loaded(spark, tmp_path / "groups")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert (result.counts["silver_inserted"], result.counts["silver_updated"]) == (10, 30)
    assert result.counts == expected.counts
    for table in ("order_slv", "fact_order", "fact_order_status_history"):
        left, right = engine.layer.read(table), whole.layer.read(table)
        assert rows(left.select(*right.columns)) == rows(right), table
    for table in ("order_slv", "fact_order"):
        assert [len(re.findall("Exchange hashpartitioning", p)) for p in plans[table, "B2"]] == [2, 2, 2, 2], table
    assert sorted(map(sorted, written["order_slv"])) == [[0], [0], [1], [1], [2], [2], [3], [3]]
    assert written["fact_order"].count({-1}) == 1 and {0} in written["fact_order"]
    assert engine.layer._names(f"{engine.layer.root}/_staging/order_brz_checked") == []


@pytest.mark.parametrize("newest_by", [None, "at"])
def test_one_join_equals_the_upsert(spark, newest_by):
    kind = "k string, v string, at int, created_at int"
    target = spark.createDataFrame([("a", "1", 5, 1), ("b", None, 5, 1), ("c", "3", None, 1), (None, "n", 5, 1), ("d", "4", 9, 1)], kind)
    batch = spark.createDataFrame([("b", "2", 6, 2), ("c", None, 1, 2), ("d", "5", 3, 2), ("e", "6", None, 2), (None, "m", 7, 2), ("a", "9", None, 2)], kind)
    for old in (target, target.limit(0)):
        made = merge.upsert_whole(old, batch, ["k"], newest_by=newest_by)
        want = merge.upsert(old, batch, ["k"], newest_by=newest_by)
        assert made.dtypes == want.dtypes and rows(made) == rows(want)


def test_values_differ_as_their_texts_do(spark):
    at = as_timestamp(datetime(2024, 1, 1))
    given = spark.createDataFrame(
        [(None, "", 1, None, 0.0), ("", None, 1, None, -0.0), ("a|", "b", None, None, None), ("a", "|b", None, None, None), ("\\", "", 2, None, float("nan"))],
        "s string, t string, n int, d decimal(5,2), f double",
    ).withColumn("at", F.when(F.col("n") == 1, at))
    names = given.columns
    a, b = (given.select(F.struct(*names).alias(n)) for n in ("a", "b"))
    plain = plain_columns(given.schema)
    assert plain == ["n", "d", "at"]
    pairs = a.crossJoin(b).select(
        texts_differ(names, "a", "b", plain).alias("found"), (row_text(names, "a") != row_text(names, "b")).alias("expected")
    )
    assert pairs.where("found <> expected OR found IS NULL").count() == 0
    assert pairs.where("found").count() == 20
