"""Connected components by label propagation with pointer jumping, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.session import settle


def components(links: DataFrame) -> DataFrame:
    """(`node`, `label`) for every node of `links` (`a`, `b`): the smallest node of its component.

    Each round takes the smallest label among the neighbours and then that label's own
    label, so chains shorten by more than half; labels are settled after each round.
    Sums and minima are combined on the map side and the joins can be split by AQE, so a
    node with very many neighbours is no single task. No links give no rows.
    """
    both = settle(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(),
        "links",
    )
    labels = settle(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("label")), "labels")
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        lower = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("low"))
        lower = settle(lower, "lower")
        jump = lower.select(F.col("node").alias("low"), F.col("low").alias("lowest"))
        jumped = lower.join(jump, "low").select("node", F.col("lowest").alias("new"), (F.col("lowest") < F.col("label")).alias("moved"))
        jumped = settle(jumped, "labels")
        moved = jumped.where("moved").limit(1).count()
        labels = jumped.select("node", F.col("new").alias("label"))
        if not moved:
            return labels
