"""Connected components of a graph that no single machine holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.session import staged


def connected(edges: DataFrame) -> DataFrame:
    """``node`` and ``label`` (the least node of its component) of every node with an edge (a, b).

    Each round takes the least label among the neighbours and then the label of that label, so
    that labels travel over ever longer distances; every round is written to the shared folder.
    """
    both = staged(
        edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges"
    )
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select(
        "node", F.least("node", "m").alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), F.col("label").alias("l")), "b")
        near = near.groupBy(F.col("a").alias("node")).agg(F.min("l").alias("l"))
        least = staged(labels.join(near, "node").select("node", "label", F.least("label", "l").alias("now")), "least")
        jump = least.select(F.col("node").alias("now"), F.col("now").alias("far"))
        moved = staged(least.join(jump, "now").select("node", "label", F.least("now", "far").alias("now")), "moved")
        if not moved.where("now != label").limit(1).count():
            return labels
        labels = moved.select("node", F.col("now").alias("label"))
