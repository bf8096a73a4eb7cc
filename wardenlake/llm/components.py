"""Connected components by smallest labels and shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardenlake.functions.storage import materialize


def components(edges: DataFrame) -> DataFrame:
    """node, label of every node with an edge (columns a, b): the smallest node it is connected to.

    Rounds of joins on written tables; each takes the smallest label among the neighbours and then the label of
    that label, so paths shrink by a factor and the number of rounds grows with the logarithm of their lengths.
    """
    both = edges.select(F.col("a").alias("src"), F.col("b").alias("dst")).where("src != dst")
    both = materialize(both.unionByName(both.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct())
    labels = materialize(both.groupBy(F.col("src").alias("node")).agg(F.least(F.first("src"), F.min("dst")).alias("label")))
    while True:
        near = both.join(labels, both["dst"] == labels["node"]).groupBy("src").agg(F.min("label").alias("near"))
        lower = labels.join(near, labels["node"] == near["src"], "left").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        ahead = labels.select(F.col("node").alias("label"), F.col("label").alias("ahead"))
        after = materialize(lower.join(ahead, "label", "left").select("node", "old", F.least("label", "ahead").alias("label")))
        labels = after.select("node", "label")
        if after.where("old != label").isEmpty():
            return labels
