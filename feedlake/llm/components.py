"""Connected components of a link table, by hooking nodes to their least neighbour and contracting the links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.workspace import materialize


def components(links: DataFrame) -> DataFrame:
    """(a, b) links -> (node, label): the least node of each node's component. Nodes without links are not listed.

    Each round hooks a node to the least of itself and its neighbours, takes that node's own hook, and rewrites the links to
    the hooks: links within one label go and repeated ones fall together, so the rounds shrink fast and their number follows
    the logarithm of the longest path. Tables are written between rounds: a hub's rows are read from files, split by
    Spark if hot, and summed map-side. Only whether links are left reaches the driver.
    """
    edges = materialize(links.select("a", "b").where("a <> b"), "cc-edges")
    labels = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("up"))
        hook = materialize(hook, "cc-hooks")
        top = hook.select(F.col("node").alias("of"), F.col("up").alias("top"))
        hook = materialize(hook.join(top, F.col("up") == F.col("of")).select("node", F.col("top").alias("up")), "cc-hooks")
        if labels is None:
            labels = hook.select("node", F.col("up").alias("label"))
        else:
            moved = labels.join(hook.select(F.col("node").alias("of"), "up"), F.col("label") == F.col("of"), "left")
            labels = materialize(moved.select("node", F.coalesce("up", "label").alias("label")), "cc-labels")
        left, right = hook.select(F.col("node").alias("a"), F.col("up").alias("x")), hook.select(F.col("node").alias("b"), F.col("up").alias("y"))
        edges = edges.join(left, "a").join(right, "b").where("x <> y")
        edges = edges.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        edges = materialize(edges, "cc-edges")
        if not edges.limit(1).count():
            return labels
