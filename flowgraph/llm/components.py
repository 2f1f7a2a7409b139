"""Connected components of a table of links, by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgraph.session import Scratch


def components(links: DataFrame, a: str = "a", b: str = "b", scratch: Scratch | None = None) -> DataFrame:
    """(node, component) of every node of ``links``: the smallest node it is connected with.

    Each round hands the smallest label over every link and then follows labels of labels, so a chain of n links takes
    about log n rounds.  Labels are written once a round, and only the last are kept; nothing but a count reaches the driver.
    """
    both = links.select(F.col(a).alias("node"), F.col(b).alias("other"))
    scratch = Scratch(links.sparkSession) if scratch is None else scratch
    both = scratch.write(both.unionByName(both.select(F.col("other").alias("node"), F.col("node").alias("other"))).distinct(), "links")
    labels = scratch.write(both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("component")), "labels")
    while True:
        over = both.join(labels.select(F.col("node").alias("other"), "component"), "other").select("node", "component")
        least = labels.unionByName(over).groupBy("node").agg(F.min("component").alias("component"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("further"))
        longer = least.join(jump, "component", "left").select("node", F.least("component", "further").alias("component"))
        after = scratch.write(longer, "labels")
        moved = after.join(labels.withColumnRenamed("component", "before"), "node").where("component <> before").limit(1).count()
        scratch.drop(labels)
        labels = after
        if not moved:
            scratch.drop(both)
            return labels
