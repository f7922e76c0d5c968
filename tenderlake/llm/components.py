"""Connected components of an edge table by label propagation with pointer jumping."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlake.llm.storage import Scratch


def connected(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """edges: a, b (orderable, not null). Returns node, label: the smallest node reachable.

    Each round every node takes the least label among its own and its neighbours',
    then the label of that label. Rounds follow the logarithm of the longest path
    in practice; each ends in a scratch table. Self-loops are harmless.
    """
    edges = scratch.table(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label"))
    labels = scratch.table(labels, "labels")
    while True:
        near = edges.join(labels.withColumnRenamed("node", "b"), "b").select(F.col("a").alias("node"), "label")
        least = near.union(labels.select("node", "label")).groupBy("node").agg(F.min("label").alias("label"))
        up = least.select(F.col("node").alias("up"), F.col("label").alias("higher"))
        jumped = least.join(up, least["label"] == up["up"]).select("node", F.least("label", "higher").alias("label"))
        fresh = scratch.table(jumped, "labels")
        moved = fresh.join(labels.withColumnRenamed("label", "was"), "node").where("label <> was").limit(1).count()
        labels = fresh
        if not moved:
            return labels
