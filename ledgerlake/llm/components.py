"""Connected components of an edge table by min-label spreading and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.scratch import stored


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): label is the smallest node of the component. Each round takes the
    least label around every node and then the label of that label; both are
    aggregations and joins that pre-aggregate, so a node with very many edges is one
    partial minimum per task. Rounds stop when no label changes."""
    pairs = stored(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b"), "edges")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = stored(both, "edges-both-ways")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label"))
                    .withColumn("label", F.least("node", "label")), "labels")
    while True:
        around = (both.join(labels, F.col("b") == F.col("node")).groupBy(F.col("a").alias("node"))
                  .agg(F.min("label").alias("near")))
        step = labels.join(around, "node").select("node", F.col("label").alias("old"),
                                                  F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        moved = stored(step.join(jump, "label", "left")
                       .select("node", "old", F.least("label", F.coalesce("next", "label")).alias("label")), "labels")
        labels = moved.select("node", "label")
        if not moved.filter("label <> old").limit(1).count():
            return labels
