"""Connected components of an edge table by smallest labels and label jumps, all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cadenza.session import write_and_read


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of (x, y): label is the smallest node it is connected to.

    Each round takes the smallest label among the neighbours, then the label of that label, so that the
    number of rounds grows with the logarithm of the longest path. Rounds are written tables.
    """
    both = edges.select(F.col("x").alias("a"), F.col("y").alias("b"))
    both = write_and_read(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"),
                                                                 F.least("a", "b").alias("label"))
    labels = write_and_read(labels, "labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "label"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        hooked = labels.join(near, "node").select("node", F.col("label").alias("old"),
                                                  F.least("label", "near").alias("label"))
        hooked = write_and_read(hooked, "hooked")
        up = hooked.select(F.col("node").alias("label"), F.col("label").alias("up"))
        jumped = hooked.join(up, "label").select("node", "old", F.least("label", "up").alias("label"))
        jumped = write_and_read(jumped, "labels")
        labels = jumped.select("node", "label")
        if jumped.filter("old <> label").isEmpty():
            return labels
