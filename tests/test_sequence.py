"""Keys cut into segments give the values of plain windows; no plan runs a job while it is built."""

import datetime
import random
import re
from decimal import Decimal

import pytest
from support import rows
from pyspark.sql import functions as F

from silverlode.operators import sequence as sq

FEATURES = [
    sq.row_number("rn"),
    sq.lag("lag1", "amount"),
    sq.lag("lag_label", "label"),
    sq.lead("lead1", "amount"),
    sq.lead("lead_label", "label"),
    sq.running("run_sum", "sum", "amount"),
    sq.running("run_count", "count", "label"),
    sq.running("run_avg", "avg", "amount"),
    sq.total("tot_sum", "sum", "amount"),
    sq.total("tot_count", "count", "label"),
    sq.total("tot_avg", "avg", "amount"),
]
SCHEMA = "k string, at timestamp, day date, id int, amount decimal(10,2), label string"


def frame(spark, seed, size=600):
    """A third of all rows has one key; NULL keys, NULL times, NULL values and ties in time occur."""
    pick = random.Random(seed)
    data = []
    for i in range(size):
        key = "hot" if i % 3 == 0 else pick.choice(["a", "b", "c", None, f"k{i}"])
        amount = None if pick.random() < 0.1 else Decimal(pick.randint(0, 9999)) / 100
        at = None if pick.random() < 0.05 else datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=20 * pick.randint(0, 200))
        data.append((key, at, at and at.date(), i, amount, pick.choice(["x", "y", None])))
    return spark.createDataFrame(data, SCHEMA)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("order", [["at", "id"], ["day", "at", "id"]])
def test_segments_equal_plain_windows(spark, seed, order):
    df = frame(spark, seed)
    cut, plain = sq.with_features(df, ["k"], order, FEATURES), sq.with_features(df, ["k"], order, FEATURES, bounded=True)
    assert cut.dtypes == plain.dtypes
    assert rows(cut) == rows(plain)


def test_two_steps_and_an_empty_frame(spark):
    df = frame(spark, 3)
    steps = [(["k"], [sq.row_number("rn"), sq.lag("before", "amount")]), (["k", "label"], [sq.row_number("own"), sq.lead("after", "id")])]
    cut = plain = df
    for keys, features in steps:
        cut, plain = sq.with_features(cut, keys, ["at", "id"], features), sq.with_features(plain, keys, ["at", "id"], features, bounded=True)
    assert rows(cut) == rows(plain)
    assert rows(sq.with_features(df.where("false"), ["k"], ["at", "id"], FEATURES)) == []


def test_a_key_with_a_third_of_the_rows_is_spread(spark):
    """Windows over rows are partitioned by key and hour: no task holds a whole key."""
    day = spark.range(24 * 60).select(F.lit("hot").alias("k"), F.timestamp_seconds(F.col("id") * 60).alias("at"), "id")
    cut = sq.with_features(day, ["k"], ["at", "id"], [sq.row_number("rn")])
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(k#" in plan and "_seg#" in plan
    per_hour = cut.groupBy(F.date_trunc("hour", "at")).agg(F.min("rn").alias("low"), F.max("rn").alias("high"))
    assert sorted((r.low, r.high) for r in per_hour.collect()) == [(60 * h + 1, 60 * h + 60) for h in range(24)]


@pytest.mark.parametrize("order,feature", [(["id"], sq.row_number("x")), (["at desc", "id"], sq.row_number("x")), (["at"], sq.lag("x", "id", 7))])
def test_what_needs_bounded_keys(spark, order, feature):
    with pytest.raises(ValueError):
        sq.with_features(frame(spark, 4, 10), ["k"], order, [feature])


def test_first_of_each(spark):
    """Copies of one row hold most of the table: exactly one of them is the first."""
    df = spark.createDataFrame([("a", 1, True)] * 300 + [("b", 2, True), ("b", 1, False), (None, 5, True), ("c", 1, None)], "k string, id int, ok boolean")
    found = sq.first_of_each(df.repartition(7, "id", F.monotonically_increasing_id()), ["k"], ["id"], F.col("ok"), "first")
    assert found.count() == 304
    assert sorted(rows(found.where("first").select("k", "id")), key=repr) == sorted([("a", 1), ("b", 2), (None, 5)], key=repr)


def test_building_a_mart_runs_no_job(spark):
    from silverlode.plans.views import MARTS
    from silverlode.sources.driver_tables import Entities

    class Read(Entities):
        """Every table is read once, as reading a file's schema is a job of its own."""

        def __getitem__(self, name):
            if name not in frames:
                frames[name] = super().__getitem__(name)
            return frames[name]

    frames = {}
    t = Read(spark, "/root/testdata/sf0.001")
    for name in t:
        t[name]
    spark.sparkContext.setJobGroup("built", "building only")
    for build in MARTS.values():
        build(t, "2001-08-01")._jdf.queryExecution().optimizedPlan()
    found = spark.sparkContext.statusTracker().getJobIdsForGroup("built")
    spark.sparkContext.setJobGroup("other", "")
    assert len(found) == 0


def test_first_of_each_moves_only_hot_keys_twice(spark, monkeypatch):
    """One window per key for all but hot keys, which are spread; the same rows are first either way."""
    rows_of = [("a", k % 40, k % 3 > 0) for k in range(300)] + [(None, k, True) for k in range(150)] + [(f"k{k}", k, True) for k in range(50)] * 2
    df = spark.createDataFrame(rows_of, "k string, id int, ok boolean").repartition(7)

    def found():
        return sq.first_of_each(df, ["k"], ["id"], F.col("ok"), "first")

    whole = sorted(rows(found()), key=repr)
    plan = found()._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"hashpartitioning\(k#\d+, _among#\d+, \d+\)", plan)) == 1
    monkeypatch.setattr(sq, "HOT_ROWS", 100)
    assert sorted(rows(found()), key=repr) == whole
    assert len(whole) == 550 and sum(r[-1] for r in whole) == 52
