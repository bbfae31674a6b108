"""Connected components of a graph with few edges per node."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbstone.plans.cut import cut
from kerbstone.plans.skew import lookup_join


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``(key, component)``: each node with the least key it is connected to.

    ``nodes`` has ``key``, ``edges`` has ``a`` and ``b``. Every round a node
    takes the least label next to it, and the labels themselves learn what any
    of their holders has found and where they point to. That halves the depth
    of the label trees as well as merging them, so the rounds grow with the
    logarithm of a component's diameter, not with the diameter. The many holders of one
    label are reduced before they are shuffled, and are served by a lookup
    that tolerates a label held by most nodes.
    """
    both = cut(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    labels = nodes.select("key", F.col("key").alias("label"))
    while True:
        seen = (
            both.join(labels, both["b"] == labels["key"])
            .groupBy("a")
            .agg(F.min("label").alias("_near"))
        )
        state = labels.join(seen, F.col("key") == F.col("a"), "left").select(
            "key", "label", F.least("label", "_near").alias("near")
        )
        found = state.groupBy("label").agg(F.min("near").alias("_low"))
        own = state.select(F.col("key").alias("label"), F.col("near").alias("_own"))
        target = found.join(own, "label").select(
            "label", F.least("_low", "_own").alias("_target")
        )
        moved = cut(
            lookup_join(state, target, "label").select(
                "key",
                F.least("near", "_target").alias("label"),
                (F.least("near", "_target") < F.col("label")).alias("changed"),
            )
        )
        labels = moved.select("key", "label")
        if moved.where("changed").isEmpty():
            return labels.select("key", F.col("label").alias("component"))
