"""Connected components by minimum labels with pointer jumping.

Each round, a node takes the least label among its own, its neighbours' and
its label's label. Labels are aggregated with `min`, so a node with very many
neighbours is combined before the shuffle; no neighbour list is ever built.
Rounds grow with the logarithm of the longest path. Each round is a stored
table; only its count of changes reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from darkroom.llm.store import discard, stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of `edges` (a, b), both bigint; the label is
    the least node of the component."""
    both = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "components-edges")
    kept = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")), "components-labels")
    labels = kept
    while True:
        near = both.join(labels.withColumnsRenamed({"node": "_node", "label": "_label"}), F.col("b") == F.col("_node")).groupBy(F.col("a").alias("_a")).agg(F.min("_label").alias("_near"))
        step = labels.join(near, F.col("node") == F.col("_a")).select("node", F.col("label").alias("old"), F.least("label", "_near").alias("_new"))
        above = labels.withColumnsRenamed({"node": "_up", "label": "_above"})
        step = stored(step.join(above, F.col("_new") == F.col("_up")).select("node", "old", F.least("_new", "_above").alias("label")), "components-labels")
        discard(kept)
        kept, labels = step, step.select("node", "label")
        if step.where("old <> label").isEmpty():
            discard(both)
            return labels
