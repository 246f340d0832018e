"""Connected components of links, by joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelgrain.llm.storage import stored


def components(links: DataFrame) -> DataFrame:
    """``node``, ``component`` for each node of ``links`` (columns ``a`` and ``b``); the component is its smallest node.

    Each round a node takes the smallest label among its neighbours' and then
    its label's label, so the rounds follow the logarithm of the longest chain.
    Labels are written out every round; nothing but the number of changes
    reaches the driver. Repeated links, links to oneself and links with a null
    end change nothing.
    """
    ends = links.where("a is not null and b is not null")
    edges = stored(ends.select("a", "b").union(ends.select("b", "a")).distinct())
    labels = stored(edges.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("component")))
    while True:
        near = edges.join(labels, edges["b"] == labels["node"]).groupBy("a").agg(F.min("component").alias("near"))
        hooked = stored(
            labels.join(near, labels["node"] == near["a"]).select("node", F.col("component").alias("old"), F.least("component", "near").alias("new"))
        )
        up = hooked.select(F.col("node").alias("up"), F.col("new").alias("component"))
        step = stored(hooked.join(up, hooked["new"] == up["up"]).select("node", "component", (F.col("old") != F.col("component")).alias("moved")))
        labels = step.select("node", "component")
        if step.where("moved").isEmpty():
            return labels
