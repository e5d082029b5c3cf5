"""Connected components by contraction: every round at least halves the nodes of each open component."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.session import checkpointed


def connected_components(edges: DataFrame) -> DataFrame:
    """``(a, b)`` long pairs to ``(node, label)``, label being the smallest node of the component.

    A round maps each node to its smallest neighbour (or itself) and replaces the edges by their images. A hot
    node is pre-aggregated in the minimum and its edges are split by the planner's skew join. Every step is a
    written table in the shared folder. No edges give no rows; loops and repeated edges are allowed; nulls are dropped.
    """
    edges = checkpointed(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a is not null and b is not null").distinct())
    both = lambda e: e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = checkpointed(both(edges).select(F.col("a").alias("node"), F.col("a").alias("label")).distinct())
    while True:
        open_edges = edges.where("a <> b")
        if open_edges.isEmpty():
            return labels
        step = checkpointed(both(open_edges).groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("to")))
        to = lambda c: step.select(F.col("a").alias(c), F.col("to").alias(f"{c}_to"))
        edges = checkpointed(
            open_edges.join(to("a"), "a").join(to("b"), "b").select(F.col("a_to").alias("a"), F.col("b_to").alias("b"))
            .where("a <> b").distinct())
        labels = checkpointed(
            labels.join(to("label"), "label", "left").select("node", F.coalesce("label_to", "label").alias("label")))
