"""Connected components of an edge table, in joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm import scratch


def components(edges: DataFrame, rounds: int = 64) -> DataFrame:
    """node, component (its least node) for every node of ``edges`` (columns a, b; any ordered type).

    Each round gives a node the least label among its own, its neighbours' and its label's label, so that labels halve
    their distance to the least one; a star needs two rounds.  Every round is a written table.  A node with very many
    neighbours is summed up before it is shuffled, and its joins can be split.
    """
    both = scratch.written(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    first = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label"))
    labels = scratch.written(first, "labels")
    for _ in range(rounds):
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        up = labels.select(F.col("node").alias("n"), F.col("label").alias("up"))
        step = labels.join(near, labels["node"] == near["a"]).join(up, F.col("label") == F.col("n"), "left")
        new = scratch.written(step.select("node", F.least("label", "near", "up").alias("label"), (F.least("label", "near", "up") != F.col("label")).alias("changed")), "labels")
        labels = new.select("node", "label")
        if not new.filter("changed").limit(1).count():
            break
    else:
        raise RuntimeError(f"labels still change after {rounds} rounds")
    return labels.select("node", F.col("label").alias("component"))
