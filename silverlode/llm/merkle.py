"""A Merkle manifest of a dataset: one tree of rows per group, one tree over the groups' roots, and a proof for every row.

H is the lower-case hex SHA-256 of its inputs one after another, digests as hex text.  A leaf is H of a row's fields, each
``-`` if null, else its UTF-8 byte count, ``:`` and the value.  Nodes have FANOUT children; the last one of a level may have
fewer, even one.  A tree of one leaf is that leaf.

Nodes live in an append log in postorder: a node is written as soon as its last child is.  Where a node stands follows from
sizes alone: before leaf i of a tree stand i leaves and i // FANOUT ** h nodes of each level h >= 1, and a node stands as
many places behind its last leaf as its level says (``leaf_place``, ``node_place``).  So builders need not know each other:
each takes an aligned run of FANOUT ** tier leaves, appends the nodes over it in completion order, and gives the run's
root to the builder above, which does the same with roots as its leaves.  A proof needs the siblings on the way up.  Those
within the run lie in the run's own stretch of the log; the few above it are addressed by their places and joined to it
once per run, not once per row.

Rows get their number within the group from a range partitioning by (group, order), row counts of the partitions and prefix
sums over these: no group and no order lands in one task.

Results: null fields count as ``-``; a null group is a group, the first one; rows that repeat are leaves of their own, side by
side; rows without an order value come first in their group, and are not tampered with; an empty table gives an empty table; texts of any length are hashed whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverlode.session import materialize

BITS, TIER = 3, 4
FANOUT = 1 << BITS
#: Number of the tree over the groups' roots; what its levels are raised by where they follow those of a lower tree.
TOP, UPPER = -1, 1 << 20


def leaf_place(i):
    """Where leaf ``i`` of a tree stands in its log: behind the leaves before it and all nodes that these complete."""
    return sum(i >> BITS * h for h in range(1, 21)) + i


def node_place(level, k, n):
    """Where node ``k`` of ``level`` stands in the log of a tree of ``n`` leaves."""
    last = np.minimum((k + 1) << BITS * level, n) - 1
    return leaf_place(last) + level


def height(n: int) -> int:
    """Levels above the leaves of a tree of ``n`` leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FANOUT), levels + 1
    return levels


def node(children: list[bytes]) -> bytes:
    """The digest over child digests, which count as hex text."""
    return hashlib.sha256("".join(c.hex() for c in children).encode()).digest()


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*map(field, values)), 256))


def numbered(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """``rows`` with their ``index`` within the group in the given order and the group's size ``n``."""
    spread = rows.withColumn("_tie", F.xxhash64(F.monotonically_increasing_id()))  # equal rows need not share a task
    spread = materialize(spread, "leaves").repartitionByRange(*group, *order, "_tie").sortWithinPartitions(*group, *order, "_tie").drop("_tie")
    placed = materialize(spread.withColumn("_part", F.spark_partition_id()).withColumn("_seq", F.monotonically_increasing_id()), "ordered")
    # a row per group and partition: at most groups + partitions, and a group has no more than there are partitions
    counts = placed.groupBy("_part", *group).agg(F.count("*").alias("_count"), F.min("_seq").alias("_first"))
    of_group = Window.partitionBy(*group)
    before = F.coalesce(F.sum("_count").over(of_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.withColumn("_before", before).withColumn("n", F.sum("_count").over(of_group)).drop("_count")
    counts = materialize(counts.withColumnsRenamed({c: f"_of_{k}" for k, c in enumerate([*group, "_part"])}), "offsets")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_of_{k}")) for k, c in enumerate([*group, "_part"])])
    found = placed.join(counts, same).withColumn("index", F.col("_seq") - F.col("_first") + F.col("_before"))
    return found.drop("_part", "_seq", "_first", "_before", *[f"_of_{k}" for k in range(len(group) + 1)])


LOG = "tree long, place long, level int, k long, n long, digest binary"


def _build(base: int, tier: int):
    """For ``applyInArrow``: an aligned run of nodes of level ``base``; returns the nodes over it, in completion order."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("k")
        tree, n, first = (rows[c][0].as_py() for c in ("tree", "n", "k"))
        top, ends = height(n) - base, -(-n // FANOUT**base)
        open_children: list[list[bytes]] = [[] for _ in range(tier)]
        level_of, k_of, digests = [], [], []
        for k, digest in enumerate(rows["digest"].to_pylist(), first):
            for level in range(min(tier, top)):
                open_children[level].append(digest)
                if (k + 1) % FANOUT ** (level + 1) and k + 1 < ends:
                    break
                digest, open_children[level] = node(open_children[level]), []
                level_of.append(base + level + 1)
                k_of.append(k // FANOUT ** (level + 1))
                digests.append(digest)
        levels, ks = np.array(level_of, np.int64), np.array(k_of, np.int64)
        places = node_place(levels, ks, n)
        same = [pa.array(np.full(len(ks), x), pa.int64()) for x in (tree, n)]
        columns = [same[0], pa.array(places, pa.int64()), pa.array(levels, pa.int32()), pa.array(ks), same[1], pa.array(digests, pa.binary())]
        return pa.table(columns, names=["tree", "place", "level", "k", "n", "digest"])

    return run


def build(leaves: DataFrame, tier: int = TIER) -> DataFrame:
    """The log of all nodes above the leaves (tree, k, n, digest), written tier by tier."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    base, below = 0, leaves.select("tree", "k", "n", "digest")
    log = leaves.sparkSession.createDataFrame([], LOG)
    while base < height(most):
        nodes = below.groupBy("tree", F.shiftright("k", BITS * tier).alias("run")).applyInArrow(_build(base, tier), LOG)
        nodes = materialize(nodes, "nodes")
        log, base = log.union(nodes), base + tier
        below = nodes.where(F.col("level") == base).select("tree", "k", "n", "digest")
    return log


def roots(log: DataFrame, leaves: DataFrame) -> DataFrame:
    """(tree, root): the last entry of each tree's log, which is its only leaf where it has no other."""
    single = leaves.where("n = 1").select("tree", F.col("digest").alias("root"))
    last = log.groupBy("tree").agg(F.max_by("digest", "place").alias("root"))
    return single.union(last)


def entries(leaves: DataFrame) -> DataFrame:
    """Leaves with the place that they have in their tree's log."""
    before = [F.shiftright("k", BITS * h) for h in range(1, 21)]
    return leaves.withColumn("place", reduce(lambda a, b: a + b, before, F.col("k")))


def _addresses(batch: pa.RecordBatch) -> list[tuple]:
    """(tree, run, level, own child number, sibling's child number, its place): what the proofs of a run need above it."""
    out = []
    for tree, run, k, n, lowest in zip(*(batch.column(c).to_pylist() for c in ("tree", "run", "k", "n", "lowest"))):
        for level in range(lowest, height(n)):
            own = k // FANOUT ** (level - lowest)
            start = own // FANOUT * FANOUT
            children = np.arange(start, min(start + FANOUT, -(-n // FANOUT**level)))
            places = node_place(level, children, n)
            found = [(tree, run, level, own - start, c - start, p) for c, p in zip(children.tolist(), places.tolist()) if c != own]
            out += found or [(tree, run, level, 0, None, None)]  # an only child
    return out


def ways(log: DataFrame, starts: DataFrame) -> DataFrame:
    """(tree, run, way): the siblings above each start (tree, run, k, n, lowest: node ``k`` of level ``lowest``), level by level."""
    kinds = {"tree": pa.int64(), "run": pa.int64(), "level": pa.int32(), "own": pa.int32(), "child": pa.int32(), "place": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(zip(*_addresses(batch))) or [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.values())], names=list(kinds))

    asked = starts.mapInArrow(run, "tree long, run long, level int, own int, child int, place long")
    held = log.select(F.col("tree").alias("_tree"), F.col("place").alias("_place"), "digest")
    met = asked.join(held, (F.col("tree") == F.col("_tree")) & (F.col("place") == F.col("_place")), "left")
    # at most FANOUT - 1 siblings a level
    return met.groupBy("tree", "run").agg(F.sort_array(F.collect_list(F.struct("level", "own", "child", "digest"))).alias("way"))


def _prove(tier: int):
    """For ``applyInArrow``: a run's stretch of the log, its leaves with ``order`` and ``tampered``, and the way above it."""

    def run(rows: pa.Table, above: pa.Table) -> pa.Table:
        leaves = rows.filter(pc.is_valid(rows["tampered"])).sort_by("k")
        if not leaves.num_rows:
            return pa.table([leaves["tree"], leaves["order"], *[pa.array([], pa.binary())] * 3], names=["tree", "order", "leaf", "proof", "folded"])
        log = dict(zip(rows["place"].to_pylist(), rows["digest"].to_pylist()))
        n, first = leaves["n"][0].as_py(), leaves["k"][0].as_py()
        levels: list[list[str]] = []  # the run's nodes of each level as hex text, in order
        for level in range(min(tier, height(n))):
            ks = np.arange(first // FANOUT**level, -(-(first + leaves.num_rows) // FANOUT**level))
            levels.append([log[place].hex() for place in node_place(level, ks, n).tolist()])
        outer: list[tuple[int, list[str]]] = []  # per level above: the own child number and the siblings
        way = above["way"][0].as_py() if above.num_rows else []
        for level in sorted({w["level"] for w in way}):
            found = [w for w in way if w["level"] == level]
            outer.append((found[0]["own"], [w["digest"].hex() for w in found if w["child"] is not None]))
        tail = "".join(d for _, siblings in outer for d in siblings)
        digests, proofs, folded = leaves["digest"].to_pylist(), [], []
        for at, (k, tampered) in enumerate(zip(leaves["k"].to_pylist(), leaves["tampered"].to_pylist())):
            steps = []
            for level, nodes in enumerate(levels):
                own, start = (at >> BITS * level) % FANOUT, at >> BITS * (level + 1) << BITS
                steps.append((own, nodes[start : start + own] + nodes[start + own + 1 : start + FANOUT]))
            proofs.append(hashlib.sha256(("".join("".join(s) for _, s in steps) + tail).encode()).digest())
            value = tampered.hex()
            for own, siblings in [*steps, *outer]:
                value = hashlib.sha256("".join([*siblings[:own], value, *siblings[own:]]).encode()).hexdigest()
            folded.append(bytes.fromhex(value))
        columns = [pa.array(c, pa.binary()) for c in (digests, proofs, folded)]
        return pa.table([leaves["tree"], leaves["order"], *columns], names=["tree", "order", "leaf", "proof", "folded"])

    return run


def manifest(rows: DataFrame, group: Column, order: Column, fields: list[Column], tampered: list[Column], tier: int = TIER) -> DataFrame:
    """(order, leaf, subroot, root, proof, folded): digests as bytes, for each row, named by its ``order`` value.

    ``fields`` make a row's leaf; ``tampered`` make the leaf that is folded, along the original siblings, up to ``folded``.
    ``tier`` is the number of levels that one builder adds.
    """
    leaves = rows.select(group.alias("group"), order.alias("order"), leaf(*fields).alias("digest"), leaf(*tampered).alias("tampered"))
    leaves = numbered(leaves, ["group"], ["order", "digest"]).withColumnRenamed("index", "k")
    groups = leaves.where("k = 0").select("group", F.lit(0).alias("one"))
    trees = materialize(numbered(groups, ["one"], ["group"]).select(F.col("group").alias("_group"), F.col("index").alias("tree"), F.col("n").alias("trees")), "trees")
    leaves = leaves.join(trees, F.col("group").eqNullSafe(F.col("_group"))).select("tree", "k", "n", "order", "digest", "tampered")
    leaves = entries(materialize(leaves, "leaves"))
    log = build(leaves, tier)
    subroots = materialize(roots(log, leaves), "subroots")
    tops = subroots.join(trees, "tree").select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("k"), F.col("trees").alias("n"), F.col("root").alias("digest"))
    tops = entries(materialize(tops, "subroots"))
    top_log = build(tops, tier)
    root = roots(top_log, tops).first()  # one row, or none of an empty table

    # above each run: the siblings within its tree, then those of its subroot
    runs = leaves.where(F.col("k") % (1 << BITS * tier) == 0).select("tree", F.shiftright("k", BITS * tier).alias("run"), "n")
    within = ways(log.where(F.col("level") >= tier), runs.select("*", F.col("run").alias("k"), F.lit(tier).alias("lowest")))
    top_entries = top_log.select("tree", "place", "digest").union(tops.select("tree", "place", "digest"))
    beyond = ways(top_entries, tops.select("tree", F.col("k").alias("run"), "k", "n", F.lit(0).alias("lowest")))
    raised = F.transform("way", lambda w: w.withField("level", w["level"] + UPPER))
    beyond = beyond.select(F.col("run").alias("tree"), raised.alias("beyond"))
    above = runs.select("tree", "run").join(within, ["tree", "run"], "left").join(beyond, "tree", "left")
    nothing = F.array().cast(within.schema["way"].dataType)
    above = above.select("tree", "run", F.concat(F.coalesce("way", nothing), F.coalesce("beyond", nothing)).alias("way"))

    columns = ["tree", "run", "k", "n", "place", "digest", "order", "tampered"]
    run_of = F.call_function("shiftright", F.col("k"), F.lit(BITS * tier) - F.lit(BITS) * F.col("level"))
    stretch = log.where(F.col("level") < tier).withColumn("run", run_of)
    stretch = stretch.withColumn("order", F.lit(None).cast(leaves.schema["order"].dataType)).withColumn("tampered", F.lit(None).cast("binary"))
    stretch = stretch.select(*columns).union(leaves.withColumn("run", F.shiftright("k", BITS * tier)).select(*columns))
    result = f"tree long, order {leaves.schema['order'].dataType.simpleString()}, leaf binary, proof binary, folded binary"
    proven = stretch.groupBy("tree", "run").cogroup(above.groupBy("tree", "run")).applyInArrow(_prove(tier), result)
    found = proven.join(subroots.withColumnRenamed("root", "subroot"), "tree")
    return found.select("order", "leaf", "subroot", F.lit(bytes(root.root) if root else None).cast("binary").alias("root"), "proof", "folded")
