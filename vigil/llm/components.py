"""Connected components of an edge list, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import shared_dir

#: Rows up to which labels are broadcast: some ten megabytes.
FEW = 200_000


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of edges (a, b); component is the smallest node that links reach.

    Each round a node takes the smallest label among its neighbours and itself,
    then its label's label. Rounds are checkpointed and end when nothing changes:
    about the logarithm of the longest path. An empty edge list gives no rows.
    Labels are broadcast where they are few, so that a round has one shuffle, and
    joined by shuffles where they are more.
    """
    shared_dir(edges.sparkSession)
    own = edges.select("a", "a").union(edges.select("b", "b"))  # a node is a neighbour of itself
    both = edges.union(edges.select("b", "a")).union(own).toDF("node", "other").distinct().checkpoint()
    labels = both.groupBy("node").agg(F.min("other").alias("component")).checkpoint()
    few = labels.count() <= FEW
    while True:
        near, jump = labels.toDF("other", "component"), labels.toDF("low", "jump")
        near, jump = (F.broadcast(near), F.broadcast(jump)) if few else (near, jump)
        old = F.max(F.when(F.col("node") == F.col("other"), F.col("component"))).alias("old")
        lower = both.join(near, "other").groupBy("node").agg(F.min("component").alias("low"), old)
        after = lower.join(jump, "low", "left").select("node", F.least("low", F.coalesce("jump", "low")).alias("component"), "old").checkpoint()
        labels = after.select("node", "component")
        if after.filter("component < old").isEmpty():
            return labels
