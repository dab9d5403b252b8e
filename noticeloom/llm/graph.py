"""Connected components of edge tables, and small helpers for keyed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeloom.session import cut_lineage

#: Rows of a few long columns that may be broadcast (some 50 MB); larger sides are shuffled.
BROADCAST_ROWS = 1_000_000


def bounded(df: DataFrame) -> DataFrame:
    """Mark a narrow table for broadcast if a count shows that it is small. Give it written tables only."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def follow(parents: DataFrame) -> DataFrame:
    """Root of every node of a forest (node, label): labels are replaced by their own labels until none changes."""
    while True:
        up = parents.select(F.col("node").alias("label"), F.col("label").alias("_up"))
        jumped = cut_lineage(parents.join(up, "label", "left").select(
            "node", F.coalesce("_up", "label").alias("label"), F.col("_up").isNotNull().alias("_moved")), "roots")
        parents = jumped.drop("_moved")
        if not jumped.where("_moved").limit(1).count():
            return parents


def relabel(df: DataFrame, column: str, labels: DataFrame) -> DataFrame:
    """Replace ids by their labels where they have one."""
    side = labels.select(F.col("node").alias(column), F.col("label").alias("_label"))
    return df.join(side, column, "left").withColumn(column, F.coalesce("_label", column)).drop("_label")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): the smallest node of its component, for all nodes with an edge but the smallest themselves.

    Every node hangs itself on its smallest smaller neighbour; the trees are flattened,
    edges are rewritten to the roots, and what still connects two roots goes on. A hot
    node is a key of a minimum with map-side combine or of a join with a unique side.
    """
    low, high = F.least(a, b), F.greatest(a, b)
    left = cut_lineage(edges.where(F.col(a) != F.col(b)).select(low.alias("a"), high.alias("b")).distinct(), "edges")
    labels = None
    while left.limit(1).count():
        roots = follow(cut_lineage(left.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("label")), "parents"))
        labels = roots if labels is None else cut_lineage(
            relabel(labels, "label", roots).unionByName(roots.join(labels, "node", "left_anti")), "labels")
        moved = relabel(relabel(left, "a", roots), "b", roots).where(F.col("a") != F.col("b"))
        left = cut_lineage(moved.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    return labels if labels is not None else left.select(F.col("b").alias("node"), F.col("a").alias("label"))
