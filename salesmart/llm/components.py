"""Connected components of an edge table, by DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import saved


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node, component`` (the smallest node of its component) for every node
    of ``edges`` (columns ``a``, ``b``; long, not NULL).

    Each round links every node to the smallest neighbour of its neighbours'
    labels and then follows the label of the label, so long chains close in
    few rounds. A round's labels are written to the shared folder; all work
    is partial aggregation and joins on node ids, whatever a node's degree.
    """
    both = saved(edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct(), "edges")
    labels = saved(both.groupBy("a").agg(F.least("a", F.min("b")).alias("component")).withColumnRenamed("a", "node"), "labels")
    for _ in range(rounds):
        near = both.join(labels.select(F.col("node").alias("b"), F.col("component").alias("c")), "b") \
            .groupBy("a").agg(F.min("c").alias("c")).withColumnRenamed("a", "node")
        one = labels.join(near, "node").select("node", "component", F.least("component", "c").alias("c"))
        jump = labels.select(F.col("node").alias("c"), F.col("component").alias("up"))
        nxt = saved(one.join(jump, "c").select("node", F.least("c", "up").alias("component"),
                                               F.col("component").alias("_before")), "labels")
        changed = nxt.filter("component <> _before").limit(1).count()
        labels = nxt.select("node", "component")
        if not changed:
            return labels
    raise RuntimeError("components did not settle")
