"""Connected components of links between 64-bit nodes, in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.durable import durable


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b); the component is its
    smallest node. Each round every node takes the smallest label among its
    neighbours, then its label's label, so a path of length d needs about log d
    rounds. Rounds are written, so lineage does not grow; the driver sees the
    number of changed labels only."""
    both = durable(links.select("a", "b").unionByName(
        links.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct(),
        "component-edges")
    labels = durable(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_b"))
                     .select("node", F.least("node", "_b").alias("component")), "component-labels")
    while True:
        near = (both.join(labels, both.b == labels.node).groupBy("a")
                .agg(F.min("component").alias("_near")))
        lower = (labels.join(near, labels.node == near.a)
                 .select("node", F.col("component").alias("_old"),
                         F.least("component", "_near").alias("_low")))
        own = labels.select(F.col("node").alias("_low"), F.col("component").alias("_jump"))
        after = durable(lower.join(own, "_low").select(
            "node", "_old", F.least("_low", "_jump").alias("component")), "component-labels")
        labels = after.select("node", "component")
        if not after.filter("component <> _old").count():
            return labels
