"""Connected components of an edge table, without bringing any of it to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.session import drop_paths, write_shared


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b): label is the smallest node reachable.

    Every round takes the smallest label among a node and its neighbours and then the label of
    that label, so rounds grow with the logarithm of the longest chain. Labels are written
    to shared storage after each round; a node with very many edges is combined before the
    shuffle of the aggregate and split by adaptive joins.
    """
    spark = edges.sparkSession
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both, both_path = write_shared(both.where("a <> b").distinct(), "edges")
    labels, path = write_shared(
        both.groupBy(F.col("a").alias("node")).agg(
            F.least(F.col("node"), F.min("b")).alias("label")
        ),
        "labels",
    )
    while True:
        seen = both.join(labels, F.col("b") == F.col("node")).select("a", "label")
        near = (
            seen.union(labels.select("node", "label"))
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        jump = labels.select(F.col("node").alias("via"), F.col("label").alias("far"))
        old = labels.select(F.col("node").alias("old_node"), F.col("label").alias("old"))
        step = (
            near.join(jump, F.col("near") == F.col("via"))
            .join(old, F.col("node") == F.col("old_node"))
            .select("node", F.least("near", "far").alias("label"), "old")
        )
        step, new_path = write_shared(step, "labels")
        changed = not step.where("label <> old").isEmpty()
        drop_paths(spark, [path])
        labels, path = step.select("node", "label"), new_path
        if not changed:
            drop_paths(spark, [both_path])
            return labels
