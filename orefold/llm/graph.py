"""Connected components of an edge table, by Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import staged


def components(edges: DataFrame) -> DataFrame:
    """``a, b`` edges to ``node, component``, the component being its smallest node; only nodes that have edges.

    Each round takes the least label among neighbours and then the label of one's label, so long paths
    shrink fast. Labels are stored after every round; only a count reaches the driver.
    """
    both = staged(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "edges")
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("component")), "labels")
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("component").alias("near"))
        one = labels.join(near, labels.node == near.a, "left").select("node", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        one = staged(one, "labels")
        parent = one.select(F.col("node").alias("parent"), F.col("component").alias("above"))
        new = staged(one.join(parent, one.component == parent.parent, "left").select("node", "old", F.coalesce("above", "component").alias("component")), "labels")
        labels = new.select("node", "component")
        if not new.where("component <> old").limit(1).count():
            return labels
