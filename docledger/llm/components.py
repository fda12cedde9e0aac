"""Connected components of a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docledger.session import checkpoint


def components(edges: DataFrame) -> DataFrame:
    """node and label, the smallest node reachable, for every node of ``edges`` (a, b: longs).

    Each round a node takes the smallest label among its neighbours', then its
    label's own label. Paths of labels shorten by half, so long chains end in a
    logarithm of their length. Minima combine before their shuffle; every
    round is checkpointed.
    """
    both = edges.where(F.col("a") != F.col("b")).select("a", "b")
    both = checkpoint(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = checkpoint(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")))
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        lowered = labels.join(near.withColumnRenamed("a", "node"), "node").select(
            "node", "label", F.least("label", "near").alias("next")
        )
        # The label a label now has: the node named by it is in the same component.
        offers = lowered.select(F.col("label").alias("node"), F.col("next").alias("offer")).groupBy("node").agg(F.min("offer").alias("offer"))
        hooked = checkpoint(
            lowered.join(offers, "node", "left").select("node", "label", F.least("next", F.coalesce("offer", "next")).alias("next"))
        )
        up = hooked.select(F.col("node").alias("next"), F.col("next").alias("jump"))
        moved = checkpoint(
            hooked.join(up, "next", "left").select("node", "label", F.least("next", F.coalesce("jump", "next")).alias("next"))
        )
        changed = moved.where(F.col("label") != F.col("next")).limit(1).count()
        labels = moved.select("node", F.col("next").alias("label"))
        if not changed:
            return labels
