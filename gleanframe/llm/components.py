"""Connected components of an edge table, by the smallest id reachable."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanframe.llm.base import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, label) for each end of an edge (longs); label: the smallest id connected to it.

    Each round takes the smallest label next to an id and then that label's own label, so the
    rounds grow with the logarithm of a component's diameter. Rounds are written down; nothing
    but the number of changes comes to the driver. Loops and repeated edges change nothing.
    """
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
    both = stored(both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    labels = stored(both.groupBy(F.col("u").alias("id")).agg(F.least(F.first("u"), F.min("v")).alias("label")), "labels")
    while True:
        near = (
            both.join(labels.withColumnRenamed("id", "v"), "v")
            .groupBy(F.col("u").alias("id"))
            .agg(F.min("label").alias("near"))
        )
        next_labels = labels.join(near, "id").select("id", "label", F.least("label", "near").alias("new"))
        jump = labels.select(F.col("id").alias("new"), F.col("label").alias("jumped"))
        next_labels = next_labels.join(jump, "new").select(
            "id", F.least("new", "jumped").alias("label"), (F.least("new", "jumped") != F.col("label")).alias("changed")
        )
        next_labels = stored(next_labels, "labels")
        labels = next_labels.select("id", "label")
        if next_labels.where("changed").isEmpty():
            return labels
