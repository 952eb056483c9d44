"""Connected components of a link table by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genopile.storage import materialize


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``node``, ``comp``: the smallest node reachable by ``links`` (``a``, ``b``).

    Every round each node takes the smallest label of its neighbours and then the label of its
    label, so the rounds grow with the logarithm of a component's width.  Labels are stored each
    round; only the number of changes comes to the driver.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialize(both.distinct(), "links")
    linked = both.select(F.col("a").alias("node")).distinct()
    labels = linked.select("node", F.col("node").alias("comp"))
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "comp"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("comp").alias("near"))
        )
        lower = labels.join(near, "node").select(
            "node", F.col("comp").alias("old"), F.least("comp", "near").alias("comp")
        )
        lower = materialize(lower, "lower")
        jump = lower.select(F.col("node").alias("comp"), F.col("comp").alias("far"))
        labels = materialize(
            lower.join(jump, "comp").select(
                "node", F.col("far").alias("comp"), (F.col("far") < F.col("old")).alias("moved")
            ),
            "labels",
        )
        moved = labels.filter("moved").count()
        labels = labels.select("node", "comp")
        if not moved:
            break
    return nodes.join(labels, "node", "left").select(
        "node", F.coalesce("comp", "node").alias("comp")
    )
