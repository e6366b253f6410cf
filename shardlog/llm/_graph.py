"""Connected components of an edge table, by minimum labels with pointer jumping; every step is a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import Scratch


def components(edges: DataFrame, scratch: Scratch, name: str = "cc", rows: int | None = None) -> DataFrame:
    """edges: a, b (long); rows: about how many nodes. Returns node, label for every node that has an edge; label is the smallest node of its component.

    Each round a node takes the smallest label among its own, its neighbours' and its label's label, so the number of rounds grows
    with the logarithm of a component's diameter. Aggregates are partial minima; a node with many edges is a hot key of joins only.
    """
    both = scratch.save(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), f"{name}-edges", rows)
    labels = scratch.save(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")), f"{name}-0", rows)
    n = 0
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        # A label of a label is never larger, and labels are nodes with edges, so the join keeps every row.
        step = labels.join(near, "node").join(jump, "label").select("node", F.least("up", "near").alias("new"), "label")
        n += 1
        kept = scratch.save(step.select("node", F.col("new").alias("label"), (F.col("new") != F.col("label")).alias("moved")), f"{name}-{n}", rows)
        moved = kept.where("moved").limit(1).count()
        labels = kept.select("node", "label")
        scratch.drop(f"{name}-{n - 1}")
        if not moved:
            return labels
