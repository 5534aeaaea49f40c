"""Exact top-k inner-product search over a pivot-distance index.

Vectors are lifted to one norm (an extra coordinate sqrt(M - |x|^2), M the largest squared norm; 0 for queries), so that
the largest inner product is the smallest distance.  Every row is keyed by its nearest pivot and cut, within that cell,
into annuli of its distance to the pivot.  A query first searches the annuli nearest to it until they hold enough rows;
the k-th distance found bounds the rest, because a row of an annulus [low, high] of pivot p is at least
max(0, low - d(q, p), d(q, p) - high) away.  Annuli beyond the bound are never visited, the others are, so the result is
exact whatever the pivots are.

Pivots come from a bounded sample (PIVOT_SAMPLE rows, the smallest hashes of the id); every row is indexed.  Annuli are
cut into blocks of at most about BLOCK rows and queries into blocks of QUERIES, and a task compares one block with one
block: neither a common vector nor a full cell lands in one task.

Results: a vector that is null or holds a null or non-finite component, or has no id, takes no part.  A shorter vector
counts as padded with zeros.  An id that occurs more than once stands for the smallest of its vectors.  Ties go to the
smaller id.  Fewer than k other rows: all of them.  No rows: no result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverlode.session import materialize

SCALE = 1024
PIVOT_SAMPLE, PIVOTS, RINGS = 4096, 64, 16
BLOCK, QUERIES = 4096, 512


def scaled(vector: Column) -> Column:
    """Each component x as floor(SCALE * x); null if the vector can't take part."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(fine, F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("long")))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists as rows of doubles, padded with zeros.  Sums of products stay exact below 2^53."""
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width))
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


def _pivots(rows: DataFrame, width: int, top: float) -> np.ndarray:
    """Lifted pivots, far apart from each other, out of a bounded sample."""
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(PIVOT_SAMPLE).select("vector").collect()
    x = np.zeros((len(sample), width + 1))
    for r, row in enumerate(sample):
        x[r, : len(row.vector)] = row.vector
    x[:, width] = np.sqrt(np.maximum(0.0, top - (x * x).sum(axis=1)))
    chosen = [0]
    far = ((x - x[0]) ** 2).sum(axis=1)
    while len(chosen) < min(PIVOTS, len(x)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
    return x[chosen]


def _distances(vectors: np.ndarray, pivots: np.ndarray, lift: np.ndarray) -> np.ndarray:
    x = np.concatenate([vectors, lift[:, None]], axis=1)
    squares = (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1)[None, :] - 2.0 * x @ pivots.T
    return np.sqrt(np.maximum(0.0, squares))


def _keyed(width: int, top: float, pivots: np.ndarray):
    """Rows (id, vector) get their cell and their distance to its pivot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), width)
            d = _distances(x, pivots, np.sqrt(np.maximum(0.0, top - (x * x).sum(axis=1))))
            cell = d.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32()), pa.array(d[np.arange(len(cell)), cell])], names=["id", "vector", "cell", "distance"])

    return run


def _visits(width: int, pivots: np.ndarray, rings: list, k: int, slack: float, later: bool):
    """Which annuli each query visits: the nearest ones holding over k rows, or (``later``) the rest within its bound."""
    cells = np.array([r[0] for r in rings], np.int64)
    number, low, high = np.array([r[1] for r in rings], np.int64), np.array([r[2] for r in rings]), np.array([r[3] for r in rings])
    counts = np.array([r[4] for r in rings], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), width)
            d = _distances(x, pivots, np.zeros(len(x)))[:, cells]
            least = np.maximum(0.0, np.maximum(low - d, d - high))
            order = np.argsort(least, axis=1, kind="stable")
            before = np.cumsum(counts[order], axis=1) - counts[order]
            first = np.empty(order.shape, bool)
            np.put_along_axis(first, order, before <= k, axis=1)  # the query's own row may be among them
            if later:
                bound = batch.column(2).to_numpy(zero_copy_only=False)
                wanted = ~first & (least <= bound[:, None] + slack)
            else:
                wanted = first
            q, ring = np.nonzero(wanted)
            rows = batch.select(["id", "vector"]).take(pa.array(q))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(cells[ring], pa.int32()), pa.array(number[ring], pa.int32())], names=["id", "vector", "cell", "ring"])

    return run


def _best(width: int, k: int):
    """Scores of one block of queries against one block of rows; the k best of each query."""

    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        if not queries.num_rows or not rows.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
        queries, rows = queries.combine_chunks(), rows.combine_chunks()
        qid, rid = queries["id"].to_numpy(), rows["id"].to_numpy()
        order = np.argsort(rid, kind="stable")
        rid = rid[order]
        x = _matrix(rows["vector"].combine_chunks(), width)[order]
        score = (_matrix(queries["vector"].combine_chunks(), width) @ x.T).astype(np.int64)
        own = qid[:, None] == rid[None, :]
        n = min(k, len(rid))
        # the query's own row goes behind all others; ties: rows stand by id
        best = np.argsort(np.where(own, np.iinfo(np.int64).max, -score), axis=1, kind="stable")[:, :n]
        found = np.take_along_axis(score, best, axis=1).ravel()
        ok = ~np.take_along_axis(own, best, axis=1).ravel()
        return pa.table({"query_id": np.repeat(qid, n)[ok], "id": rid[best.ravel()][ok], "score": found[ok]})

    return run


def _search(visits: DataFrame, indexed: DataFrame, sizes: DataFrame, width: int, k: int) -> DataFrame:
    """The k best rows per query and block, for the annuli in ``visits``."""
    blocks = visits.groupBy("cell", "ring").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("qblocks")).join(sizes, ["cell", "ring"])
    deal = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    others = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    keys = ["cell", "ring", "rblock", "qblock"]
    asked = visits.join(blocks, ["cell", "ring"]).withColumn("qblock", deal("qblocks")).withColumn("rblock", others("rblocks"))
    held = indexed.join(blocks, ["cell", "ring"]).withColumn("rblock", deal("rblocks")).withColumn("qblock", others("qblocks"))
    found = asked.select(*keys, "id", "vector").groupBy(*keys).cogroup(held.select(*keys, "id", "vector").groupBy(*keys))
    return found.applyInArrow(_best(width, k), "query_id long, id long, score long")


def _ranked(scores: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, queries: Column, k: int = 10, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row where ``queries`` holds, its k best other rows."""
    session = vectors.sparkSession
    usable = vectors.select(F.col(id).cast("long").alias("id"), scaled(F.col(vector)).alias("vector"), F.coalesce(queries, F.lit(False)).alias("asked"))
    usable = usable.where("id IS NOT NULL AND vector IS NOT NULL").groupBy("id").agg(F.min("vector").alias("vector"), F.max("asked").alias("asked"))
    usable = materialize(usable, "vectors")
    shape = usable.agg(F.max(F.size("vector")).alias("width"), F.max(F.aggregate("vector", F.lit(0).cast("long"), lambda a, x: a + x * x)).alias("top")).first()
    schema = "query_id long, rank int, vec_id long, score long"
    if shape.width is None:
        return session.createDataFrame([], schema)
    width, top = shape.width, float(shape.top)
    pivots = _pivots(usable, width, top)
    keyed = usable.select("id", "vector").mapInArrow(_keyed(width, top, pivots), "id long, vector array<long>, cell int, distance double")
    keyed = materialize(keyed, "keyed")
    # one row per cell, at most PIVOTS: annuli of about equal counts
    cuts = keyed.groupBy("cell").agg(F.percentile_approx("distance", [r / RINGS for r in range(1, RINGS)], 1000).alias("cuts"))
    ring = F.size(F.filter("cuts", lambda c: c < F.col("distance")))
    indexed = materialize(keyed.join(F.broadcast(cuts), "cell").select("id", "vector", "cell", ring.alias("ring"), "distance"), "annuli")
    stats = materialize(indexed.groupBy("cell", "ring").agg(F.min("distance").alias("low"), F.max("distance").alias("high"), F.count("*").alias("n")), "rings")
    rings = [tuple(r) for r in stats.select("cell", "ring", "low", "high", "n").collect()]  # at most PIVOTS * RINGS rows
    sizes = F.broadcast(stats.select("cell", "ring", F.ceil(F.col("n") / BLOCK).cast("int").alias("rblocks")))
    asked = usable.where("asked").select("id", "vector")
    slack = 1e-6 * math.sqrt(4 * top + 1)  # rounding of distances; a larger bound only visits more
    went = "id long, vector array<long>, cell int, ring int"
    near = _search(asked.mapInArrow(_visits(width, pivots, rings, k, slack, False), went), indexed.drop("distance"), sizes, width, k)
    near = materialize(_ranked(near, k).drop("rank"), "near")
    # the k-th distance so far, by |q - x|^2 = |q|^2 + M - 2 q.x in the lifted space
    norm = F.aggregate("vector", F.lit(0).cast("long"), lambda a, x: a + x * x)
    worst = near.groupBy("query_id").agg(F.min("score").alias("worst"), F.count("*").alias("n"))
    bound = F.when(F.col("n") >= k, F.sqrt(F.greatest(F.lit(0.0), norm + F.lit(top) - 2 * F.col("worst")))).otherwise(F.lit(float("inf")))
    bounded = asked.join(worst, asked.id == worst.query_id, "left").select("id", "vector", F.coalesce(bound, F.lit(float("inf"))).alias("bound"))
    rest = _search(bounded.mapInArrow(_visits(width, pivots, rings, k, slack, True), went), indexed.drop("distance"), sizes, width, k)
    merged = _ranked(near.union(rest), k)
    return merged.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")
