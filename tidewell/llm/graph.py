"""Connected components by spreading the least label; labels and links stay in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut


def least_labels(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, label) for every node of ``links`` (columns a, b): label is its component's least node.

    Each round every node takes the least label among itself and its neighbours, then the label of
    that label's node, so that chains shrink to a half; rounds end when no label changes.
    """
    both = cut(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut(both.groupBy("a").agg(F.min("b").alias("l")).select(F.col("a").alias("node"), F.least("a", "l").alias("label")))
    for _ in range(most_rounds):
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("l"))
        step = labels.join(near, labels["node"] == near["a"]).select("node", F.least("label", "l").alias("to"), F.col("label").alias("old"))
        jump = step.select(F.col("node").alias("n2"), F.col("to").alias("t2"))
        new = step.join(jump, step["to"] == jump["n2"], "left").select("node", F.least("to", F.coalesce("t2", "to")).alias("label"), "old")
        new = cut(new)
        if new.where("label <> old").isEmpty():
            return new.select("node", "label")
        labels = new.select("node", "label")
    raise RuntimeError("labels still change; the links form a longer chain than most_rounds allows")
