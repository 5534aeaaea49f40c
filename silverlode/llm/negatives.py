"""Hard negatives: the best-scoring rows of other labels just below an anchor's own positives.

Scores are integer inner products, computed by Four-Russians tables.  The components of an anchor are cut into groups of
eight dimensions; a table of a group holds the sum of each of its 256 subsets.  A candidate is packed once into bit planes:
one byte per plane and group, holding bit j of its eight components (two's complement, so the top plane counts negative).
Its score is a sum of table entries, one per plane and group, shifted by the plane; no product is formed.

Anchors are cut into blocks of about ANCHORS rows and candidates into blocks of about ROWS by a hash of the id; a task scores
one block against one block and passes on what can be among the best, so neither a label nor a vector makes a large task.
The first pass finds the positives of each anchor, the second the negatives below each positive's score.

Results: a row without id or label, or whose vector is null, holds a null or non-finite component or is so long that a
hundredfold score may not fit 63 bits (a sum of squares above LARGEST), takes no part.  A shorter vector counts as padded with zeros.
An id that occurs more than once stands for the smallest of its (label, vector).  Ties go to the smaller id.  Fewer rows
than asked for: all of them.  An anchor without positives or negatives, or an empty table, gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverlode.session import materialize

SCALE = 256
ANCHORS, ROWS = 1024, 4096
#: Anchors whose tables are used at once: 2 KB a group and anchor.
TABLES = 64
LARGEST = 9.0e16
GROUP = 8


def whole_components(vector: Column, scale: int = SCALE) -> Column:
    """Each component x as floor(scale * x); null if the vector can't take part."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    floors = lambda: F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    size = F.aggregate(vector, F.lit(0.0), lambda a, x: a + F.pow(F.floor(x.cast("double") * scale).cast("double"), F.lit(2.0)))
    return F.when(F.when(fine, size) <= LARGEST, floors())


def components_of(column: pa.Array, width: int) -> np.ndarray:
    """Lists of integers as rows, padded with zeros to a multiple of GROUP dimensions."""
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), -(-width // GROUP) * GROUP), np.int64)
    out[np.arange(out.shape[1])[None, :] < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def planes_of(x: np.ndarray, bits: int) -> np.ndarray:
    """(rows, bits, groups) bytes: bit j of the eight components of each group."""
    return np.stack([np.packbits(((x >> j) & 1).astype(np.uint8), axis=1, bitorder="little") for j in range(bits)], axis=1)


def subset_sums(anchors: np.ndarray, kind: type) -> np.ndarray:
    """(groups, 256, anchors): the sum over each subset of the eight dimensions of a group."""
    by_group = anchors.T.reshape(-1, GROUP, len(anchors))
    sums = np.zeros((len(by_group), 1 << GROUP, len(anchors)), kind)
    for d in range(GROUP):
        sums[:, 1 << d : 2 << d] = sums[:, : 1 << d] + by_group[:, d, None]
    return sums


def scores_of(planes: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """(anchors, rows) inner products by lookups and shifts, from the top plane down."""
    total = np.zeros((len(planes), sums.shape[2]), sums.dtype)
    for j in reversed(range(planes.shape[1])):
        total <<= 1
        top = j == planes.shape[1] - 1
        for g in range(planes.shape[2]):
            found = sums[g][planes[:, j, g]]
            if top:
                total -= found
            else:
                total += found
    return total.T


def _packed(width: int, bits: int):
    """For ``mapInArrow``: rows (id, label, asked, vector) get their planes; only anchors keep the vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                planes = planes_of(components_of(batch.column(3), width), bits).reshape(batch.num_rows, -1)
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([p.tobytes() for p in planes], pa.binary())], names=["id", "label", "asked", "planes"])

    return run


def _scored(width: int, bits: int, kind: type, choose: Callable, schema: pa.Schema):
    """For ``applyInArrow``: a block of anchors against a block of rows; ``choose`` picks from one anchor's scores."""

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if anchors.num_rows and rows.num_rows:
            rows = rows.combine_chunks().sort_by("id")
            anchors = anchors.combine_chunks()
            ids, labels = rows["id"].to_numpy(), rows["label"].to_numpy()
            planes = np.frombuffer(b"".join(rows["planes"].to_pylist()), np.uint8).reshape(len(ids), bits, -1)
            asked = components_of(anchors["vector"].combine_chunks(), width)
            details = anchors.drop_columns(["vector"]).to_pylist()
            for a in range(0, len(asked), TABLES):
                scores = scores_of(planes, subset_sums(asked[a : a + TABLES], kind))
                for detail, score in zip(details[a : a + TABLES], scores):
                    out += choose(detail, ids, labels, score.astype(np.int64))
        columns = list(zip(*out)) or [[] for _ in schema]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def _positives(k: int) -> Callable:
    def choose(anchor: dict, ids: np.ndarray, labels: np.ndarray, score: np.ndarray) -> list[tuple]:
        at = np.flatnonzero((labels == anchor["label"]) & (ids != anchor["id"]))
        if len(at) > k:
            least = -np.partition(-score[at], k - 1)[k - 1]
            at = at[score[at] >= least]
        at = at[np.argsort(-score[at], kind="stable")][:k]  # rows stand by id
        return [(anchor["id"], int(ids[i]), int(score[i])) for i in at]

    return choose


def _negatives(k: int, low: int, high: int) -> Callable:
    def choose(anchor: dict, ids: np.ndarray, labels: np.ndarray, score: np.ndarray) -> list[tuple]:
        positive = np.array([p["score"] for p in anchor["positives"]], np.int64)
        at = np.flatnonzero((labels != anchor["label"]) & (100 * score <= high * positive.max()) & (100 * score >= low * positive.min()))
        at = at[np.argsort(-score[at], kind="stable")]
        hundred = 100 * score[at]
        out = []
        for p in anchor["positives"]:
            start = int(np.searchsorted(-hundred, -high * p["score"], side="left"))
            end = int(np.searchsorted(-hundred, -low * p["score"], side="right"))
            out += [(anchor["id"], p["id"], p["score"], int(ids[i]), int(score[i])) for i in at[start : min(end, start + k)]]
        return out

    return choose


def _met(asked: DataFrame, held: DataFrame, blocks: tuple[int, int], run: Callable, schema: str) -> DataFrame:
    """Every block of ``asked`` with every block of ``held``."""
    deal = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    keys = ["ablock", "rblock"]
    left = asked.withColumn("ablock", deal(blocks[0])).withColumn("rblock", every(blocks[1]))
    right = held.select("id", "label", "planes").withColumn("rblock", deal(blocks[1])).withColumn("ablock", every(blocks[0]))
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, schema)


_POSITIVES = "anchor_id long, positive_id long, positive_score long"
_NEGATIVES = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"


def _arrow(schema: str) -> pa.Schema:
    return pa.schema([(column.split()[0], pa.int64()) for column in schema.split(", ")])


def hard_negatives(
    vectors: DataFrame, anchors: Column, label: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
    scale: int = SCALE, id: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows where ``anchors`` holds; ``label`` is the label of a row.  For each of an anchor's best ``positives`` rows
    of its label, the best ``negatives`` rows of other labels whose score is between ``low`` and ``high`` percent of the positive's.
    """
    rows = vectors.select(F.col(id).cast("long").alias("id"), label.cast("long").alias("label"), F.coalesce(anchors, F.lit(False)).alias("asked"), whole_components(F.col(vector), scale).alias("vector"))
    rows = rows.where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    rows = rows.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("row"), F.max("asked").alias("asked")).select("id", "row.label", "asked", "row.vector")
    rows = materialize(rows, "vectors")
    # floor(-1) and its complement 0 need the same bits; a null means no component at all
    widest = F.max(F.aggregate("vector", F.lit(0).cast("long"), lambda a, x: F.greatest(a, x, -1 - x)))
    norm = F.max(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
    shape = rows.agg(F.max(F.size("vector")).alias("width"), widest.alias("widest"), norm.alias("norm"), F.count("*").alias("n"), F.count_if("asked").alias("asked")).first()
    width, bits = max(1, shape.width or 0), int(shape.widest or 0).bit_length() + 1
    kind = np.int32 if width * 4.0 ** (bits - 1) < 2**30 else np.int64  # partial sums fit, too
    blocks = max(1, -(-shape.asked // ANCHORS)), max(1, -(-shape.n // ROWS))
    held = materialize(rows.mapInArrow(_packed(width, bits), "id long, label long, asked boolean, planes binary"), "planes")
    asked = rows.where("asked").select("id", "label", "vector")
    near = _met(asked, held, blocks, _scored(width, bits, kind, _positives(positives), _arrow(_POSITIVES)), _POSITIVES)
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    chosen = near.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= positives)
    best = chosen.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct(F.col("nth"), F.col("positive_id").alias("id"), F.col("positive_score").alias("score")))).alias("positives"))
    best = materialize(best, "positives")
    asked = asked.join(best, asked.id == best.anchor_id).drop("anchor_id")
    found = _met(asked, held, blocks, _scored(width, bits, kind, _negatives(negatives, low, high), _arrow(_NEGATIVES)), _NEGATIVES)
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
