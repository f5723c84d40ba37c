"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subscope.llm.stage import stored


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every end of the links ``a, b``: label is the least node reachable.

    Each round gives a node the least label among itself and its neighbours, and then that label's own
    label, so labels travel ever longer ways. A node with a third of all links is a hot key of a join,
    which adaptive execution splits, and of a minimum, which tasks take first. Nothing is collected.
    """
    both = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select(
        "node", F.least("node", "b").alias("label")
    ))
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("label").alias("near")
        )
        pulled = stored(labels.join(near, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
        ))
        jump = pulled.select(F.col("node").alias("label"), F.col("label").alias("next"))
        labels = stored(pulled.join(jump, "label", "left").select(
            "node", "old", F.least("label", F.coalesce("next", "label")).alias("label")
        ))
        if labels.where("label < old").isEmpty():
            return labels.select("node", "label")
        labels = labels.select("node", "label")
