"""Connected components of links between numbered nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from telemill.llm.shared import staged


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``links`` (``a``, ``b``), the label being the smallest
    node of its component.

    Each round hooks every node to its smallest neighbour and draws the links between what is
    left. Only a node without a smaller neighbour is left, so each round at least halves the
    nodes that have links. All tables stay on the cluster; a node with very many links is
    aggregated in parts, and joined to by splitting it.
    """
    edges = staged(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "edges")
    labels = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        hooks = both.groupBy("a").agg(F.min("b").alias("b"))
        hooks = staged(hooks.select(F.col("a").alias("node"), F.least("a", "b").alias("hook")), "hooks")
        # A hook's own hook is nearer to the end of its chain.
        ends = hooks.select(F.col("node").alias("hook"), F.col("hook").alias("end"))
        hooks = staged(hooks.join(ends, "hook").select("node", F.col("end").alias("hook")), "hooks")
        if labels is None:
            labels = hooks.withColumnRenamed("hook", "label")
        else:
            moved = labels.join(hooks, labels["label"] == hooks["node"], "left")
            labels = staged(moved.select(labels["node"], F.coalesce("hook", "label").alias("label")), "labels")
        moved = edges.join(hooks.select(F.col("node").alias("a"), F.col("hook").alias("x")), "a")
        moved = moved.join(hooks.select(F.col("node").alias("b"), F.col("hook").alias("y")), "b")
        edges = staged(
            moved.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges"
        )
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels
