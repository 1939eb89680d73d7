"""Connected components of a link table, by minimum labels and pointer jumping."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import stages


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links(a, b)``; a component is its smallest node.

    Each round every node takes the smallest label among its own and its
    neighbours', then the label of that label; labels only fall, and equal
    labels across every link end the loop.  Sums per node are pre-aggregated
    before the shuffle, so a node with very many links is no hot task.
    """
    both = stages.table(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .where("a <> b").distinct(), "links")
    label = stages.table(
        both.groupBy("a").agg(F.min("b").alias("low")).select(
            F.col("a").alias("node"), F.least("a", "low").alias("component")), "labels")
    while True:
        near = (both.join(label.select(F.col("node").alias("b"), "component"), "b")
                .groupBy("a").agg(F.min("component").alias("low")))
        step = label.join(near, label.node == near.a).select(
            "node", F.col("component").alias("old"), F.least("component", "low").alias("low"))
        up = label.select(F.col("node").alias("low"), F.col("component").alias("above"))
        new = stages.table(
            step.join(up, "low", "left").select(
                "node", "old", F.least("low", F.coalesce("above", "low")).alias("component")), "labels")
        stages.discard(label)
        label = new.select("node", "component")
        if new.where("component <> old").isEmpty():
            stages.discard(both)
            return label
