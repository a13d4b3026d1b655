"""Connected components of an undirected graph, on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.scratch import scratch_table


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` of every node with an edge: the smallest node reachable.

    Each round a node takes the smallest label around it, and then the label of
    that label, so long chains halve. Labels and edges stay distributed; rounds
    are cut by written tables. Loops, repeated and null edges are allowed.
    """
    pairs = edges.where(f"{a} <> {b}").select(F.col(a).alias("node"), F.col(b).alias("other"))
    both = scratch_table(pairs.union(pairs.select("other", "node")).distinct(), "edges")
    labels = both.groupBy("node").agg(F.min("other").alias("m")).select(
        "node", F.least("node", "m").alias("component")
    )
    labels = scratch_table(labels, "labels")
    while True:
        around = (
            both.join(labels.select(F.col("node").alias("other"), "component"), "other")
            .groupBy("node")
            .agg(F.min("component").alias("m"))
        )
        taken = labels.join(around, "node").select(
            "node", F.col("component").alias("old"), F.least("component", "m").alias("now")
        )
        further = taken.select(F.col("node").alias("now"), F.col("now").alias("component"))
        step = taken.join(further, "now").select("node", "old", "component")
        step = scratch_table(step, "labels")
        labels = step.select("node", "component")
        if step.where("old <> component").isEmpty():
            return labels
