"""Connected components of a link table by joins: smallest label of the neighbours, then the label's own label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); component is the smallest node reachable.

    Labels only fall; each round takes the smallest label around a node and then the label of
    that label, so chains halve. Rounds go on until nothing changes.
    """
    both = saved(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    labels = saved(both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("component")), "labels")
    while True:
        around = (
            both.join(labels.select(F.col("node").alias("b"), F.col("component").alias("c")), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("c").alias("c"))
        )
        lower = labels.join(around, "node").select("node", "component", F.least("component", "c").alias("c"))
        of = labels.select(F.col("node").alias("c"), F.col("component").alias("cc"))
        new = saved(lower.join(of, "c").select("node", "component", F.least("c", "cc").alias("c")), "labels")
        if new.where(F.col("c") != F.col("component")).isEmpty():
            return labels
        labels = new.select("node", F.col("c").alias("component"))
