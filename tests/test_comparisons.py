"""Global positions and comparison by content, with hot values, NULLs and repeats."""

import random

from support import rows

from silverlode.operators import content, position


def test_positions_with_hot_values_and_nulls(spark):
    rng = random.Random(2)
    made = [(k, rng.choice([None, 1.0, 1.0, 1.0, rng.random()])) for k in range(500)] + [(7, 1.0)] * 200
    df = spark.createDataFrame(made, "id long, v double").repartition(9)
    got = position.with_position(df, ["v desc", "id"]).collect()
    order = lambda r: (r[1] is None, -(r[1] or 0), r[0])
    assert [(r.id, r.v) for r in sorted(got, key=lambda r: r.position)] == sorted(made, key=order)
    assert sorted(r.position for r in got) == list(range(1, len(made) + 1))
    assert position.with_position(df.limit(0), ["id"]).count() == 0


def test_dense_ranks(spark):
    rng = random.Random(3)
    made = [(k, rng.choice([None, *range(20)]), rng.choice("ab")) for k in range(300)]
    df = spark.createDataFrame(made, "id long, v long, w string").repartition(5)
    values = sorted({(v, w) for _, v, w in made}, key=lambda x: (x[0] is None, -(x[0] or 0), x[1]))
    got = {r.id: r["rank"] for r in position.with_dense_rank(df, ["v desc", "w"]).collect()}
    assert got == {k: values.index((v, w)) + 1 for k, v, w in made}


def test_changed_swapped_missing_and_repeated_rows_are_found(spark):
    source = [(k, f"c{k % 7}", k % 5, None if k % 11 == 0 else "x") for k in range(400)] + [(500, "a", 1, "r")] * 300
    held = {r[0]: r for r in source if r[0] not in (13, 500)}
    held[20], held[30] = (20, held[30][1], *held[20][2:]), (30, held[20][1], *held[30][2:])  # values of two rows exchanged
    held[40] = (40, held[40][1], held[40][2], "")
    target = [*held.values(), *[(500, "a", 1, "r")] * 299, (900, "new", 0, "x")]
    schema = "k long, c string, n long, t string"
    a, b = (spark.createDataFrame(x, schema).repartition(3) for x in (source, target))
    assert held[20] != source[20] and held[40] != source[40]
    got = rows(content.differing_rows(a, b, ["k"], ["k", "c", "n", "t"], buckets=16))
    want = [(k, side, "CHANGED", 1) for k in (20, 30, 40) for side in ("SOURCE", "TARGET")]
    assert got == sorted([*want, (13, "SOURCE", "MISSING_IN_TARGET", 1), (500, "SOURCE", "MISSING_IN_TARGET", 1), (900, "TARGET", "MISSING_IN_SOURCE", 1)], key=repr)
    assert content.differing_rows(a, a.repartition(7), ["k"], ["k", "c", "n", "t"]).count() == 0


def test_bucket_states_and_sums_over_batches(spark):
    schema = "k long, v string"
    a = spark.createDataFrame([(k, f"v{k}") for k in range(100)], schema)
    swapped = spark.createDataFrame([(k, f"v{ {3: 4, 4: 3}.get(k, k) }") for k in range(100)], schema)
    states = {r.status for r in content.compare_checksums(content.checksums(a, ["k"], ["k", "v"], 8), content.checksums(swapped, ["k"], ["k", "v"], 8)).collect()}
    assert states == {"MATCH", "CONTENT_MISMATCH"}
    parts = [content.checksums(a.where(f"k % 2 = {p}"), ["k"], ["k", "v"], 8) for p in (0, 1)]
    summed = parts[0].union(parts[1]).groupBy("bucket").sum("row_count", "sum_1", "sum_2")
    assert rows(summed) == rows(content.checksums(a, ["k"], ["k", "v"], 8))
    empty = content.compare_checksums(content.checksums(a, ["k"], ["k"], 2), content.checksums(a.limit(0), ["k"], ["k"], 2))
    assert {r.status for r in empty.collect()} == {"COUNT_MISMATCH"} and {r.target_count for r in empty.collect()} == {0}
