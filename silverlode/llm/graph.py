"""Connected components of an edge table, by label passing and pointer jumping over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.session import materialize


#: Rounds that thin out the edges before labels are passed.
CONTRACTIONS = 2


def contracted(edges: DataFrame) -> DataFrame:
    """Fewer edges (u > v) with the same components: each node keeps its smallest neighbour below it, and what else was
    below it is tied to that one instead.  Edges of nodes that are linked many times over become the same few edges."""
    down = materialize(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct(), "edges")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    tied = down.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return least.select("u", F.col("m").alias("v")).union(tied).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every node of ``edges``; the label is the smallest node of its component.

    Edges are thinned out first (``contracted``).  Each round then gives a node the smallest label around it and then follows that label once, so that a path of length n
    takes about log n rounds.  Every round is a written table: nothing is collected, lineage stays short, and a lost
    executor repeats one round at most.  Sides with a null, self loops and repeated edges have no effect.
    """
    ends = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v"))
    for _ in range(CONTRACTIONS):
        ends = contracted(ends)
    both = materialize(ends.union(ends.select("v", "u")), "edges")
    labels = materialize(both.groupBy(F.col("u").alias("node")).agg(F.least(F.col("node"), F.min("v")).alias("label")), "labels")
    while True:
        around = both.join(labels.withColumnRenamed("node", "v"), "v").groupBy(F.col("u").alias("node")).agg(F.min("label").alias("near"))
        lower = labels.join(around, "node").select("node", F.least("label", "near").alias("low"), F.col("label").alias("was"))
        target = labels.select(F.col("node").alias("low"), F.col("label").alias("beyond"))
        after = lower.join(target, "low", "left").select("node", F.least("low", "beyond").alias("label"), "was")
        after = materialize(after, "labels")
        labels = after.select("node", "label")
        if after.where("label <> was").isEmpty():
            return labels
