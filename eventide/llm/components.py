"""Connected components of an edge table by label joins and pointer jumping; nothing passes through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import materialize


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the least node of each component, for all nodes that occur in ``edges``.

    Every round takes the least label among the neighbours, then the label of that label; rounds grow with the
    logarithm of a component's diameter.  Each round's labels are written to the shared folder."""
    both = materialize(edges.select(F.col(a).alias("a"), F.col(b).alias("b"))
                       .unionByName(edges.select(F.col(b).alias("a"), F.col(a).alias("b"))).distinct(), "edges")
    labels = materialize(both.groupBy("a").agg(F.min("b").alias("b"))
                         .select(F.col("a").alias("node"), F.least("a", "b").alias("label")), "labels")
    while True:
        near = (both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near")))
        step = (labels.join(near, F.col("node") == F.col("a"), "left")
                .select("node", F.col("label").alias("old"), F.least("label", "near").alias("label")))
        step = materialize(step, "labels-near")
        jump = step.select(F.col("node").alias("at"), F.col("label").alias("far"))
        new = materialize(step.join(jump, F.col("label") == F.col("at"), "left")
                          .select("node", "old", F.least("label", "far").alias("label")), "labels")
        changed = new.filter("label <> old").limit(1).count()
        labels = new.select("node", "label")
        if not changed:
            return labels.withColumnRenamed("label", "component")
