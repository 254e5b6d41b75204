"""Connected components of a stored edge table by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.session import materialize


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes of ``edges`` (a, b), a stored table: the smallest node reachable.

    Every round takes the smallest label among a node's neighbours and then the label's own label, and is
    stored, so lost executors repeat a round's tasks at most. Rounds end when no label changes.
    """
    both = edges.select(F.col("a").alias("src"), F.col("b").alias("dst"))
    both = materialize(both.union(both.select("dst", "src")).distinct(), "edges")
    labels = materialize(both.groupBy("src").agg(F.min("dst").alias("near")).select(F.col("src").alias("node"), F.least("src", "near").alias("component")), "labels")
    while True:
        near = both.join(labels, both["dst"] == labels["node"]).groupBy("src").agg(F.min("component").alias("near"))
        stepped = labels.join(near, labels["node"] == near["src"]).select("node", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        stepped = materialize(stepped, "stepped")
        root = stepped.select(F.col("node").alias("root"), F.col("component").alias("above"))
        jumped = stepped.join(root, stepped["component"] == root["root"]).select("node", F.least("component", "above").alias("component"), (F.least("component", "above") < F.col("old")).alias("changed"))
        jumped = materialize(jumped, "labels")
        labels = jumped.select("node", "component")
        if jumped.where("changed").isEmpty():
            return labels
