"""Connected components by least-label rounds with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node reachable, for every node of the (a, b) edges.

    Each round gives a node the least label among its neighbours, then the
    label of that label, so long chains shrink by a factor each round.  Every
    round is written to the shared folder; the loop ends when no label moves.
    """
    both = store(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct(), "edges")
    labels = store(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        step = labels.join(near, "node").select("node", F.col("component").alias("before"), F.least("component", "near").alias("component"))
        jump = step.select(F.col("node").alias("component"), F.col("component").alias("further"))
        moved = step.join(jump, "component", "left").select("node", "before", F.coalesce("further", "component").alias("component"))
        after = store(moved, "labels")
        labels = after.select("node", "component")
        if not after.filter("component <> before").take(1):
            return labels
