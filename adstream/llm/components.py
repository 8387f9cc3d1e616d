"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adstream.llm.scratch import Scratch


def connected_components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is its smallest node.

    Each round takes the smallest label among the neighbours (aggregated before the
    shuffle) and then the label of that label, so long chains shrink by squaring.
    Nodes and edges stay in Spark; only a count of changes comes back.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = scratch.save(both.filter("a <> b").distinct(), f"{name}-both")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    labels = scratch.save(labels.withColumn("component", F.least("node", "component")), f"{name}-0")
    step = 0
    while True:
        of_b = labels.select(F.col("node").alias("b"), F.col("component").alias("near"))
        near = both.join(of_b, "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        lower = labels.join(near, "node").select(
            "node", F.least("component", "near").alias("next"), F.col("component").alias("was")
        )
        root = labels.select(F.col("node").alias("next"), F.col("component").alias("jump"))
        step += 1
        found = scratch.save(
            lower.join(root, "next").select("node", F.least("next", "jump").alias("component"), "was"),
            f"{name}-{step}",
        )
        scratch.drop(f"{name}-{step - 1}")
        labels = found.select("node", "component")
        if found.filter("component <> was").isEmpty():
            scratch.drop(f"{name}-both")
            return labels
